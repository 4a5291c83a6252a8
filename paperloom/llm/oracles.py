"""SQL that must give the rows of the queries, where SQL can express them."""

from paperloom.llm.secret_scan import ACCESS, ASSIGN, ASSIGN_VALUE, HEX

ORACLES: dict[str, str] = {}


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


def _spans(kind: int, name: str, pattern: str, value: str = "") -> str:
    """Matches numbered by their place; a match starts after the texts and matches before it."""
    pattern = _quoted(pattern)
    return f"""
SELECT doc_id, {kind} AS kind, '{name}' AS name, start, start + length(found[i]) AS stop
FROM (SELECT doc_id, found, kept, i,
             list_sum([length(x) for x in gaps[1:i]]) + coalesce(list_sum([length(x) for x in found[1:i-1]]), 0) AS start
      FROM (SELECT doc_id, gaps, found, kept, unnest(generate_series(1, len(found))) AS i
            FROM (SELECT doc_id, regexp_split_to_array(body, '{pattern}') AS gaps,
                         regexp_extract_all(body, '{pattern}') AS found,
                         regexp_extract_all(body, '{pattern}', {2 if value else 0}) AS kept
                  FROM bodies))) {value}"""


ORACLES["op5_blob_ledger_secrets"] = f"""
WITH bodies AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
spans AS ({_spans(0, "assign", ASSIGN, f"WHERE length(kept[i]) >= {ASSIGN_VALUE}")}
UNION ALL {_spans(1, "access", ACCESS)}
UNION ALL {_spans(2, "hex", HEX)}),
joined AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
         count(*) FILTER (kind = 2) AS n_hex,
         string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) AS spans
  FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN joined USING (doc_id)"""

# The classes are bytes: other characters are neither lowered nor separators.
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+')"

ORACLES["op10_broadcast_decontamination"] = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS words FROM documents),
items AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
sizes AS (SELECT item_id, words, least(len(words), 10) AS size FROM items WHERE len(words) > 0),
windows AS (
  SELECT DISTINCT item_id, size, array_to_string(words[i:i+size-1], ' ') AS spelling
  FROM (SELECT item_id, words, size, unnest(generate_series(1, len(words) - size + 1)) AS i FROM sizes)),
lengths AS (SELECT DISTINCT size FROM windows),
runs AS (
  SELECT doc_id, size, i, array_to_string(words[i:i+size-1], ' ') AS spelling
  FROM (SELECT doc_id, words, size, unnest(generate_series(1, len(words) - size + 1)) AS i
        FROM docs, lengths WHERE len(words) >= size)),
hits AS (SELECT doc_id, item_id, i, size FROM runs JOIN windows USING (size, spelling)),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit
           FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN places USING (doc_id) LEFT JOIN named USING (doc_id)"""

ORACLES["op7_cover_tree_search"] = """
WITH ints AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, x.vec_id,
         CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(x.v AS DOUBLE[])) AS BIGINT) AS score
  FROM ints q JOIN ints x ON q.vec_id % 100 = 0 AND q.vec_id <> x.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
WHERE rank <= 10"""

ORACLES["op12_framed_fill_in_middle"] = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS body, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
numbers AS (
  SELECT doc_id, body, CAST(length(body) AS BIGINT) AS n,
         CAST('0x' || d[1:8] AS BIGINT) AS h1, CAST('0x' || d[9:16] AS BIGINT) AS h2,
         CAST('0x' || d[17:24] AS BIGINT) AS h3, CAST('0x' || d[25:32] AS BIGINT) AS h4 FROM texts),
formed AS (
  SELECT doc_id, body, n, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
         CASE WHEN n = 0 OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
parts AS (SELECT *, substr(body, 1, low) AS prefix, substr(body, low + 1, high - low) AS middle, substr(body, high + 1) AS suffix FROM formed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN low END AS prefix_chars, CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM parts"""

# Turns are searched by recursion, with the best cost, edits and lines of every last role; DuckDB has no crc32.
ORACLES["op13_survivor_repair"] = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS t),
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS body,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
kinds AS (
  SELECT conv_id, turn, role, body,
         xor(list_reduce(list_transform(string_split(name, ''), lambda x: CAST(ascii(x) AS BIGINT)),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS kind FROM named, crc),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(body, '[.!?]', '', 'g') ELSE body END AS body,
         unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM kinds),
turns AS (
  SELECT conv_id, turn, role, body, role[1:1] AS initial,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(body), copy) AS i,
         count(*) OVER (PARTITION BY conv_id) AS n,
         lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(body), copy) AS before,
         CASE WHEN NOT regexp_matches(body, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, body ORDER BY turn NULLS FIRST, copy) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(body, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault
  FROM damaged),
inserts(st, letters, mid, lines) AS (
  VALUES ('', '', '', CAST([] AS VARCHAR[])), ('', 'I', 'u', ['user:']), ('', 'II', 'a', ['user:', 'assistant:']),
         ('s', '', 's', []), ('s', 'I', 'u', ['user:']), ('s', 'II', 'a', ['user:', 'assistant:']),
         ('u', '', 'u', []), ('u', 'I', 'a', ['assistant:']), ('u', 'II', 'u', ['assistant:', 'user:']),
         ('a', '', 'a', []), ('a', 'I', 'u', ['user:']), ('a', 'II', 'a', ['user:', 'assistant:'])),
walk AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, n, '' AS st, {'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': CAST([] AS VARCHAR[])} AS best FROM turns
  UNION ALL
  SELECT conv_id, i, n, st, min({'cost': cost, 'audit': audit, 'lines': lines})
  FROM (
    SELECT w.conv_id, r.i, w.n, CASE x WHEN 'D' THEN mid WHEN 'K' THEN initial ELSE CASE mid WHEN 'u' THEN 'a' ELSE 'u' END END AS st,
           w.best.cost + 3 * length(letters) + CASE x WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
             + CASE WHEN x <> 'D' AND fault = 'truncated' THEN 3 ELSE 0 END AS cost,
           w.best.audit || letters || x AS audit,
           w.best.lines || t.lines || CASE x WHEN 'D' THEN [] WHEN 'K' THEN [role || ':' || body]
             ELSE [CASE mid WHEN 'u' THEN 'assistant:' ELSE 'user:' END || body] END AS lines
    FROM walk w JOIN turns r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = w.i + 1
    JOIN inserts t ON t.st = w.st CROSS JOIN (VALUES ('D'), ('K'), ('R')) AS acts(x)
    WHERE x = 'D' OR fault NOT IN ('blank', 'duplicate') AND (x = 'R' OR initial = 's' AND mid = '' OR initial = 'u' AND mid <> 'u' OR initial = 'a' AND mid = 'u'))
  GROUP BY conv_id, i, n, st),
ends AS (
  SELECT conv_id, min({'cost': best.cost + 3 * length(letters), 'audit': best.audit || letters, 'lines': best.lines || t.lines}) AS best
  FROM walk w JOIN inserts t ON t.st = w.st
  WHERE i = n AND (mid = 'a' OR mid = '') GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM turns GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(e.best.cost, 0) AS cost, coalesce(e.best.audit, '') AS audit,
       sha256(coalesce(array_to_string(e.best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ends e ON o.conv_id IS NOT DISTINCT FROM e.conv_id"""

ORACLES["op11_seed_and_extend"] = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i+49], ' ')) AS spelling
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 49)) AS i FROM docs WHERE len(words) >= 50)),
firsts AS (SELECT spelling, min(doc_id) AS first FROM windows GROUP BY spelling),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS p FROM windows JOIN firsts USING (spelling) WHERE doc_id > first),
counted AS (SELECT doc_id, list(p) AS places FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN places IS NULL THEN words ELSE
         [words[j] FOR j IN range(1, len(words) + 1) IF NOT list_contains(places, j)] END, ' '), '')) AS kept_sha256
FROM docs d LEFT JOIN counted c USING (doc_id)"""
