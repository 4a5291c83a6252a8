"""SQL fragments that several oracles share."""

from paperloom.constants import HASH_DIM, SAMPLE_PRIME, SPACE_CLASS, UNHELPFUL_NAMES
from paperloom.functions.html import NAMED_CHARACTERS

SPACES = f"{SPACE_CLASS}+"


def words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{SPACES}'), lambda w: w <> '')"


def stem(path: str) -> str:
    trimmed = f"regexp_replace({path}, '(?:(?:^|/)\\.?)+$', '', 'g')"
    segment = f"regexp_extract({trimmed}, '[^/]*$')"
    return f"regexp_replace({segment}, '(?s)^(.+)\\.[^.]+$', '\\1')"


_URL_STEM = stem(
    "regexp_replace(regexp_extract(regexp_replace(url, '[\\t\\r\\n]', '', 'g'), "
    "'^https?://[^/?#]*([^?#]*)', 1), ';[^/]*$', '')"
)

# Names of pages: (page_id, url, html, name).
NAMED_PAGES = f"""
stems AS (
  SELECT page_id, url, html, regexp_matches(url, '^https?://') AS is_url,
         CASE WHEN regexp_matches(url, '^https?://') THEN {_URL_STEM} ELSE {stem("url")} END AS stem
  FROM pages),
named AS (
  SELECT page_id, url, html, regexp_replace(
    CASE WHEN is_url AND (length(stem) < 3 OR lower(stem) IN
              {UNHELPFUL_NAMES})
         THEN 'doc_' || substr(md5(url), 1, 10) ELSE stem END,
    '[^A-Za-z0-9._-]', '_', 'g') AS name
  FROM stems)"""


_NAMES = ", ".join(f"'{name}': chr({ord(character)})" for name, character in NAMED_CHARACTERS.items())


def items_of(html: str) -> str:
    """Items of pages whose markup is ``html``, as CTEs: (page_id, item_idx, label, level, text).

    Tags are those that HTML knows by their first character, references are resolved by their number or name.
    """
    item, name = "chr(30)", "chr(31)"
    text = f"replace(replace({html}, {item}, ''), {name}, '')"
    for pattern, new in (
        (
            r"(?is)<(?:!--.*?--|script\b.*?</script\s*|style\b.*?</style\s*|nav\b.*?</nav\s*"
            r'|footer\b.*?</footer\s*|head\b.*?</head\s*|div class="ad">.*?</div\s*)>',
            "''",
        ),
        (
            r"""(?i)<img\b[^>]*?\bsrc\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))[^>]*>""",
            f"{item} || 'img' || {name} || '\\1\\2\\3' || {item} || {name}",
        ),
        (r"(?i)<t[dh]\b[^>]*>", "' | '"),
        (r"(?i)<(/?(?:h[1-6]|p|li|tr|pre))\b[^>]*>", f"{item} || '\\1' || {name}"),
        (r"<[A-Za-z/!?][^>]*>", "' '"),
    ):
        text = f"regexp_replace({text}, '{pattern}', {new}, 'g')"
    return rf"""
stripped AS (SELECT page_id, string_split({text}, '&') AS parts FROM pages),
loose AS (
  SELECT page_id, i, parts[i] AS part, regexp_extract(parts[i], '^([#A-Za-z][0-9A-Za-z]*);', 1) AS ref
  FROM stripped, LATERAL (SELECT unnest(generate_series(1, len(parts))) AS i)),
codes AS (
  SELECT *, CASE WHEN regexp_matches(ref, '^#[xX][0-9A-Fa-f]{{1,6}}$') THEN ('0x' || ref[3:])::BIGINT
                 WHEN regexp_matches(ref, '^#[0-9]{{1,7}}$') THEN ref[2:]::BIGINT END AS code FROM loose),
known AS (
  SELECT *, CASE WHEN code IN (9, 10, 13) OR code BETWEEN 32 AND 55295 OR code BETWEEN 57344 AND 1114111 THEN chr(code::INT)
                 WHEN code IS NOT NULL THEN chr(65533) ELSE MAP {{{_NAMES}}}[ref] END AS shown FROM codes),
joined AS (
  SELECT page_id, string_agg(CASE WHEN i = 1 THEN part WHEN shown IS NULL THEN '&' || part
                                  ELSE shown || substr(part, length(ref) + 2) END, '' ORDER BY i) AS text
  FROM known GROUP BY page_id),
marks AS (
  SELECT page_id, {item} || {name} || regexp_replace(text, '[ \t\n\r\x{{0b}}\x{{0c}}\x{{85}}\x{{a0}}]+', ' ', 'g') AS text FROM joined),
segments AS (
  SELECT page_id, unnest(string_split(text, chr(30))) AS segment,
         generate_subscripts(string_split(text, chr(30)), 1) AS place
  FROM marks),
tagged AS (
  SELECT page_id, place, lower(split_part(segment, chr(31), 1)) AS tag,
         trim(regexp_extract(segment, '[^\x{{1f}}]*$'), ' ') AS raw
  FROM segments WHERE segment <> ''),
cut AS (
  SELECT page_id, place, tag,
         CASE WHEN tag = 'tr' THEN regexp_replace(raw, '^\| ', '') ELSE raw END AS text
  FROM tagged),
items AS (
  SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY place) - 1)::INT AS item_idx,
         CASE WHEN tag = 'h1' THEN 'title' WHEN regexp_matches(tag, '^h[1-6]$') THEN 'section_header'
              WHEN tag = 'li' THEN 'list_item' WHEN tag = 'tr' THEN 'table_row'
              WHEN tag = 'pre' THEN 'code' WHEN tag = 'img' THEN 'picture' ELSE 'text' END AS label,
         CASE WHEN regexp_matches(tag, '^h[1-6]$') THEN substr(tag, 2, 1)::INT ELSE 0 END AS level,
         text
  FROM cut WHERE text <> '')"""


# Items of pages: (page_id, item_idx, label, level, text).
ITEMS = items_of("html")


def pieces(settings: str) -> str:
    """Word ranges of text items under each setting; ``settings`` lists (setting, limit, merge).

    The pages hold first-level headings only, so the last heading is the whole path.
    """
    return f"""
settings(setting, max_tokens, merge) AS (VALUES {settings}),
placed AS (
  SELECT *, {words("text")} AS w,
         count(*) FILTER (WHERE level > 0) OVER before AS section,
         last_value(CASE WHEN level > 0 THEN text END IGNORE NULLS) OVER before AS heading
  FROM items
  WINDOW before AS (PARTITION BY page_id ORDER BY item_idx ROWS UNBOUNDED PRECEDING)),
sized AS (
  SELECT placed.*, setting, merge, coalesce(len({words("heading")}), 0) AS heading_tokens,
         greatest(1, max_tokens - coalesce(len({words("heading")}), 0)) AS budget
  FROM placed, settings WHERE level = 0 AND label <> 'picture'),
ranges AS (
  SELECT *, unnest(range(0, len(w), budget)) AS start FROM sized),
pieces AS (
  SELECT page_id, setting, merge, section, heading, heading_tokens, budget, label,
         least(budget, len(w) - start) AS size,
         CASE WHEN len(w) <= budget THEN text
              ELSE array_to_string(list_slice(w, start + 1, start + budget), ' ') END AS text,
         row_number() OVER (PARTITION BY page_id, setting ORDER BY item_idx, start) - 1 AS p
  FROM ranges)"""


# Chunks from pieces: (page_id, setting, chunk_index, text, headings, heading_tokens, tokens, labels).
PACKED = """
packing AS (
  SELECT page_id, setting, p, section, 0::BIGINT AS chunk_index, budget - size AS room
  FROM pieces WHERE p = 0
  UNION ALL
  SELECT x.page_id, x.setting, x.p, x.section,
         m.chunk_index + CASE WHEN x.merge AND x.section = m.section AND x.size <= m.room THEN 0 ELSE 1 END,
         CASE WHEN x.merge AND x.section = m.section AND x.size <= m.room THEN m.room ELSE x.budget END - x.size
  FROM packing m JOIN pieces x ON x.page_id = m.page_id AND x.setting = m.setting AND x.p = m.p + 1),
chunks AS (
  SELECT page_id, setting, chunk_index, string_agg(text, chr(10) ORDER BY p) AS text,
         string_agg(label, ',' ORDER BY p) AS labels, any_value(heading) AS heading,
         any_value(heading_tokens) AS heading_tokens, sum(size)::BIGINT AS tokens
  FROM packing JOIN pieces USING (page_id, setting, p)
  GROUP BY page_id, setting, chunk_index)"""

DEFAULT_SETTING = "('default', 1024, true)"


def hashed(source: str, key: str, text: str, prefix: str) -> str:
    """Sparse hashing vectors as CTEs: ``{prefix}_vec(key, b, x)`` and ``{prefix}_len(key, len)``.

    The word hash is CRC-32, spelled out over the bytes of each distinct word.
    """
    return f"""
{prefix}_words AS (SELECT {key}, unnest({words(text)}) AS w FROM {source}),
{prefix}_table AS (
  SELECT list(list_reduce(list_prepend(n, range(8)),
         lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) AS t
  FROM range(256) AS r(n)),
{prefix}_hashes AS (
  SELECT w, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(octet_length(encode(w))),
      lambda i: ('0x' || substr(hex(encode(w)), (2 * i + 1)::INT, 2))::BIGINT)),
    lambda c, byte: xor(t[(xor(c, byte) & 255) + 1], c >> 8))) AS code
  FROM (SELECT DISTINCT w FROM {prefix}_words), {prefix}_table),
{prefix}_codes AS (SELECT {key}, code FROM {prefix}_words JOIN {prefix}_hashes USING (w)),
{prefix}_sums AS (
  SELECT {key}, code % {HASH_DIM} AS b, sum(CASE WHEN code >= 2147483648 THEN -1 ELSE 1 END) AS v
  FROM {prefix}_codes GROUP BY ALL),
{prefix}_raw AS (
  SELECT {key}, greatest(sqrt(sum(v * v)), 1e-12) AS length FROM {prefix}_sums GROUP BY {key}),
{prefix}_vec AS (
  SELECT {key}, b, (v / length)::FLOAT::DOUBLE AS x FROM {prefix}_sums JOIN {prefix}_raw USING ({key})),
{prefix}_len AS (
  SELECT {key}, greatest(sqrt(sum(x * x)), 1e-12) AS len FROM {prefix}_vec GROUP BY {key})"""


def sparse_text(source: str, key: str, prefix: str) -> str:
    """Sparse vectors as text, one row per key of ``source``."""
    return f"""
SELECT {key}, coalesce(string_agg(b || ':' || round(x * 1e6)::BIGINT, ',' ORDER BY b) FILTER (WHERE x <> 0), '') AS vector
FROM (SELECT DISTINCT {key} FROM {source}) LEFT JOIN {prefix}_vec USING ({key}) GROUP BY {key}"""


def fold_table(source: str, key: str, number: int, keep: str) -> str:
    """Rows of ``source`` in folds per dataset: (dataset, key, keep, fold, fold_size, total)."""
    return f"""
shuffled AS (
  SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY md5({key} || '-42'), {key}) - 1 AS p,
         count(*) OVER (PARTITION BY dataset) AS n,
         least(count(*) OVER (PARTITION BY dataset), {number}) AS k
  FROM {source}),
numbered AS (
  SELECT dataset, {key}, {keep}, n AS total,
         (CASE WHEN p < (n % k) * (n // k + 1) THEN p // (n // k + 1)
               ELSE (n % k) + (p - (n % k) * (n // k + 1)) // (n // k) END)::INT AS fold
  FROM shuffled),
folded AS (SELECT *, count(*) OVER (PARTITION BY dataset, fold) AS fold_size FROM numbered)"""


def folds(number: int) -> str:
    """Embeddings in folds: (vec_id, label, fold, fold_size, total, v), raw and as units."""
    return f"""
one_dataset AS (SELECT 'embeddings' AS dataset, * FROM embeddings),
{fold_table("one_dataset", "vec_id", number, "label, embedding")},
vectors AS (
  SELECT * EXCLUDE (embedding), list_transform(embedding, lambda x: x::DOUBLE) AS v FROM folded),
units AS (
  SELECT * REPLACE (list_transform(v, lambda x: x / greatest(sqrt(list_dot_product(v, v)), 1e-12)) AS v)
  FROM vectors)"""


def greedy(key: str, sizes: list) -> str:
    """Greedy picks from ``sims(dataset, fold, i, j, s)`` and ``folded``, merged over folds.

    Gives ``greedy``, ``picks`` (per size) and ``merged`` (with rank and subset size).
    """
    budgets, keeps = [], []
    for size in sizes:
        if isinstance(size, float):
            budgets.append(f"greatest(1, ceil({size}::DOUBLE * fold_size))::BIGINT")
            keeps.append(f"greatest(1, floor({size}::DOUBLE * total))::BIGINT")
        else:
            budgets.append(f"greatest(1, ceil({size}::DOUBLE * (fold_size::DOUBLE / total::DOUBLE)))::BIGINT")
            keeps.append(f"least({size}, total)")
    names = [f"percent_{s}" if isinstance(s, float) else f"samples_{s}" for s in sizes]
    per_size = "\n      UNION ALL ".join(
        f"SELECT dataset, fold, {no} AS size_no, '{name}' AS size_spec, {b} AS budget, {k} AS keep FROM sized"
        for no, (name, b, k) in enumerate(zip(names, budgets, keeps))
    )
    gain = (
        "round(list_sum(list_transform(list_zip(c.s, g.cover), lambda p: greatest(p[1] - p[2], 0.0))), 7)"
    )
    return f"""
    candidates AS (SELECT dataset, fold, j, list(s ORDER BY i) AS s FROM sims GROUP BY dataset, fold, j),
    sized AS (SELECT DISTINCT dataset, fold, fold_size, total FROM folded),
    budgets AS ({per_size}),
    greedy AS (
      SELECT dataset, fold, -1 AS pick_no, NULL::BIGINT AS j, NULL::DOUBLE AS gain, []::BIGINT[] AS picked,
             list_transform(range(fold_size), lambda x: 0.0::DOUBLE) AS cover, greatest({", ".join(budgets)}) AS most
      FROM sized
      UNION ALL
      SELECT dataset, fold, pick_no, j, gain, picked, cover, most FROM (
        SELECT g.dataset, g.fold, g.pick_no + 1 AS pick_no, c.j, list_append(g.picked, c.j) AS picked, g.most,
               list_transform(list_zip(c.s, g.cover), lambda p: greatest(p[1], p[2])) AS cover,
               {gain} AS gain,
               row_number() OVER (PARTITION BY g.dataset, g.fold ORDER BY {gain} DESC, c.j) AS place
        FROM greedy g JOIN candidates c ON c.dataset = g.dataset AND c.fold = g.fold
        WHERE g.pick_no + 1 < g.most AND NOT list_contains(g.picked, c.j))
      WHERE place = 1),
    picks AS (
      SELECT g.dataset, g.fold, b.size_no, b.size_spec, g.pick_no, g.j AS {key}, g.gain, b.keep
      FROM greedy g JOIN budgets b ON b.dataset = g.dataset AND b.fold = g.fold AND g.pick_no < b.budget
      WHERE g.pick_no >= 0),
    merged AS (
      SELECT *, row_number() OVER (PARTITION BY dataset, size_no ORDER BY gain DESC, fold, pick_no) - 1 AS rank
      FROM picks)"""


def sampled_greedy(sizes: list, epsilon: float) -> str:
    """Picks of greedy over a sample per step, from ``sims``, ``budgets``, ``candidates`` and ``folded``: (fold, size_no, pick_no, j, gain).

    A step's sample is the rows with the least ``factor * code + shift`` modulo a prime; factor and shift come
    from a digest of seed, fold, size and step, the code from a digest of the key.
    """
    gain = (
        "round(list_sum(list_transform(list_zip(c.s, g.cover), lambda p: greatest(p[1] - p[2], 0.0))), 7)"
    )
    name = "md5('42:' || g.fold || ':' || g.size_no || ':' || (g.pick_no + 1))"
    place = (
        f"((code * (1 + ('0x' || substr({name}, 1, 8))::BIGINT % {SAMPLE_PRIME - 1})"
        f" + ('0x' || substr({name}, 9, 8))::BIGINT % {SAMPLE_PRIME}) % {SAMPLE_PRIME})"
    )
    return f"""
    codes AS (SELECT dataset, fold, vec_id AS j, ('0x' || substr(md5(vec_id || '-42'), 1, 8))::BIGINT % {SAMPLE_PRIME} AS code FROM folded),
    sampled AS (
      SELECT b.dataset, b.fold, b.size_no, b.budget, -1 AS pick_no, NULL::BIGINT AS j, NULL::DOUBLE AS gain, []::BIGINT[] AS picked,
             greatest(1, ceil(s.fold_size::DOUBLE / b.budget::DOUBLE * ln(1.0 / {epsilon})))::BIGINT AS wanted,
             list_transform(range(s.fold_size), lambda x: 0.0::DOUBLE) AS cover
      FROM budgets b JOIN sized s USING (dataset, fold)
      UNION ALL
      SELECT dataset, fold, size_no, budget, pick_no, j, gain, picked, wanted, cover FROM (
        SELECT g.dataset, g.fold, g.size_no, g.budget, g.pick_no + 1 AS pick_no, c.j, list_append(g.picked, c.j) AS picked, g.wanted,
               list_transform(list_zip(c.s, g.cover), lambda p: greatest(p[1], p[2])) AS cover, {gain} AS gain,
               row_number() OVER (PARTITION BY g.dataset, g.fold, g.size_no ORDER BY {gain} DESC, c.j) AS best
        FROM (SELECT g.*, codes.j AS drawn,
                     row_number() OVER (PARTITION BY g.dataset, g.fold, g.size_no ORDER BY {place}, codes.j) AS place
              FROM sampled g JOIN codes ON codes.dataset = g.dataset AND codes.fold = g.fold
              WHERE g.pick_no + 1 < g.budget AND NOT list_contains(g.picked, codes.j)) g
        JOIN candidates c ON c.dataset = g.dataset AND c.fold = g.fold AND c.j = g.drawn
        WHERE g.place <= g.wanted)
      WHERE best = 1)"""


# Centroid of every label: (label, v).
CENTROIDS = """
cells AS (
  SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS place FROM embeddings),
means AS (SELECT label, place, avg(x) AS x FROM cells GROUP BY label, place),
centroids AS (SELECT label, list(x ORDER BY place) AS v FROM means GROUP BY label)"""
