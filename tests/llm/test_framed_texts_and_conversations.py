"""Fill-in-middle frames and conversation repair beside brute-force versions, and on awkward rows."""

import hashlib
import os
import random
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from paperloom.llm import conversation_repair, fill_middle, queries

FOLDER = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

TEXTS = [
    (1, ""), (2, None), (None, "no id here"), (3, "ab" * 5000), (4, "same"), (4, "same"), (4, "other"), (5, "has <S> in it"), (6, "ünïcödé 𝒳𝒴𝒵 ß\n" * 40),
    (7, "𝒳" * 25), (8, "x"),
] + [(100 + i, f"text number {i} " * (i % 7 + 1)) for i in range(60)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_fim(key, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", low, high, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", low, high, f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.fixture(scope="module")
def texts(spark):
    frame = spark.createDataFrame(TEXTS, "doc_id long, text string")
    return frame.selectExpr("*", "1 AS row", "'x' AS key", "2 AS n", "'y' AS frame", "0 AS place", "'z' AS form", "3 AS part")


@pytest.mark.parametrize("units", [1, 7, 64, fill_middle.FRAME_UNITS])
def test_fill_in_middle_equals_brute_force(texts, units):
    output = fill_middle.fill_in_middle(texts, frame_units=units)
    found = fill_middle.fim_digests(output).collect()
    got = sorted((str(r["key"]), r["n"], r["form"], str(r["cut1"]), str(r["cut2"]), r["output_sha256"], r["restored_sha256"]) for r in found)
    expected = []
    for key, text in TEXTS:
        n, form, low, high, out = brute_fim(key, text)
        expected.append((str(key), n, form, str(low), str(high), sha(out), sha(text or "")))
    assert got == sorted(expected)


def test_output_frames_can_be_opened_alone(texts):
    rows = fill_middle.fill_in_middle(texts.where("doc_id IN (3, 6)"), frame_units=100).orderBy("row", "place", "frame_no").collect()
    opener = zstandard.ZstdDecompressor()
    for key in (3, 6):
        own = [(opener.decompress(r["frame"]).decode(), r["units"]) for r in rows if r["key"] == key]
        assert all(len(body) == units <= 100 for body, units in own)
        assert "".join(body for body, _ in own) == brute_fim(key, dict(TEXTS)[key])[4]


def test_frames_hold_cumulative_counts(texts):
    rows = fill_middle.to_frames(texts.select("doc_id", "text"), frame_units=64).where("doc_id = 3").orderBy("frame_no").collect()
    assert [r["first_unit"] for r in rows] == list(range(0, 10_000, 64))
    assert sum(r["units"] for r in rows) == 10_000


def test_fill_in_middle_of_an_empty_table(texts):
    assert fill_middle.fim_digests(fill_middle.fill_in_middle(texts.limit(0))).count() == 0


def test_fill_in_middle_shuffles_nothing(texts):
    plan = fill_middle.fim_digests(fill_middle.fill_in_middle(texts))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def brute_repair(turns):
    """Least (cost, letters, lines) over all edits; turns are (turn, role, text) in order."""
    seen, faults = set(), []
    for _, role, text in turns:
        body = text.strip("\t\n\x0b\f\r ")
        if not body:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    best = {"": (0, "", ())}

    def put(into, state, way):
        if state not in into or way < into[state]:
            into[state] = way

    def inserted(ways):
        found = dict(ways)
        for _ in range(2):
            for state, (cost, letters, lines) in list(found.items()):
                role = "assistant" if state == "u" else "user"
                put(found, role[0], (cost + 3, letters + "I", (*lines, f"{role}:")))
        return found

    for (_, role, text), fault in zip(turns, faults):
        after = {}
        for first, way in best.items():
            # Each way is carried on alone, so that ways with different letters are never merged before the row's own edit.
            for state, (cost, letters, lines) in inserted({first: way}).items():
                put(after, state, (cost + 4, letters + "D", lines))
                if fault in ("blank", "duplicate"):
                    continue
                cost += 3 * (fault == "truncated")
                other = "assistant" if state == "u" else "user"
                put(after, other[0], (cost + 3, letters + "R", (*lines, f"{other}:{text}")))
                initial = role[:1]
                if (initial, state) in (("s", ""), ("u", ""), ("u", "s"), ("u", "a"), ("a", "u")):
                    put(after, initial, (cost, letters + "K", (*lines, f"{role}:{text}")))
        best = after
    ends = inserted(best)
    cost, letters, lines = min(ends[s] for s in ("", "a") if s in ends)
    initials = [role[:1] for _, role, _ in turns]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    known = [t for t, _, _ in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, letters, sha("\n".join(lines))


def in_order(rows):
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))


def brute_all(rows):
    grouped = {}
    for conv, *rest in rows:
        grouped.setdefault(conv, []).append(tuple(rest))
    return {conv: brute_repair(in_order(own)) for conv, own in grouped.items()}


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id long, turn long, role string, text string"


def repaired(frame):
    found = conversation_repair.repair_digests(conversation_repair.repair(frame)).collect()
    assert len(found) == len({r["conv"] for r in found})
    return {r["conv"]: tuple(r[c] for c in COLUMNS) for r in found}


def random_turns(rng, conv, count):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No!", "half a", " ", "", None, "Why? ", "多い.", "end.\n"]
    return [(conv, rng.choice([None, *range(count)]), rng.choice(roles), rng.choice(texts + [f"Line {rng.random()}."] * 12)) for _ in range(count)]


def test_repair_equals_brute_force(spark):
    rng = random.Random(5)
    rows = [r for conv in range(300) for r in random_turns(rng, conv, rng.randrange(1, 9))] + random_turns(rng, None, 7)
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS conv", "2 AS at", "'x' AS place", "'y' AS letters", "0 AS part", "1 AS mark")
    assert repaired(frame) == brute_all(rows)


@pytest.mark.parametrize("role", ["tool", None, "system", "user"])
def test_long_conversations_go_over_many_partitions(spark, role):
    """Illegal or equal roles for a long time: survivors share nothing for hundreds of rows, over several pieces."""
    rng = random.Random(7)
    rows = [(1, t, "user" if rng.random() < 0.1 else role, f"Row {t}.") for t in range(600)]
    rows += random_turns(rng, 2, 300) + random_turns(rng, 0, 5) + random_turns(rng, 3, 5)
    held = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.createDataFrame(rows, SCHEMA)
        out = conversation_repair.repair(frame)
        assert out.where("conv = 1").select(F.spark_partition_id()).distinct().count() > 1
        assert repaired(frame) == brute_all(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", held)


def test_survivors_hold_what_they_disagree_on_only():
    search = conversation_repair.Survivors()
    certain = []
    for at in range(5000):
        certain += search.feed(at, "ua"[at % 2], None)
        assert at - len(certain) < 3
    certain += search.finish()
    assert [c[2] for c in certain] == ["K"] * 5000


def test_no_turns(spark):
    assert repaired(spark.createDataFrame([], SCHEMA)) == {}


@tables
def test_repair_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    damaged = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if kind == 1 else text.translate(str.maketrans("", "", ".!?")) if kind == 2 else text
        damaged += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    expected = brute_all(damaged)
    nothing = (0, 0, 0, 0, 0, 0, "", sha(""))
    found = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in queries.QUERIES["op13_survivor_repair"](spark, FOLDER).collect()}
    assert found == {r[0]: expected.get(r[0], nothing) for r in rows}
