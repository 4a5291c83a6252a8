"""Fill-in-middle texts out of seekable compressed frames.

A text is stored as zstandard frames that can each be opened alone, with the number of code points before and in each.
A cut opens the one frame it falls into; all other frames move as they are. Output and restored text are frames in an order of
their own, read one at a time. The frames of a text are rows that never leave their partition: there is no shuffle, local
sorts may spill, and no task holds more than a frame of a text that it has once read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paperloom.llm.common import text_chunks, utf8

#: Code points of a frame; the last one of a text may have fewer.
FRAME_UNITS = 16_384
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_SENTINELS = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
_ROWS = 256
_LEVEL = 1


def _with(schema: StructType, ddl: str, without: tuple[str, ...]) -> StructType:
    return StructType([f for f in schema if f.name not in without] + StructType.fromDDL(ddl).fields)


def _batch(columns: list, schema: StructType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, [f.name for f in schema])


def to_frames(texts: DataFrame, text: str = "text", frame_units: int = FRAME_UNITS) -> DataFrame:
    """The other columns with (frame_no, first_unit, units, frame), a row for each frame of each text.

    A null text counts as empty; an empty text has one frame of 0 units, so that no row is lost. A text of any length is cut
    into frames of ``frame_units`` code points. An empty table gives no rows.
    """
    schema = _with(texts.schema, "frame_no int, first_unit long, units int, frame binary", (text,))

    def task(batches):
        packer = zstandard.ZstdCompressor(level=_LEVEL)
        for batch in text_chunks(batches, text):
            data, offsets = utf8(batch.column(text))
            owner, numbers, firsts, units, frames = [], [], [], [], []
            for row in range(batch.num_rows):
                at, end, number = int(offsets[row]), int(offsets[row + 1]), 0
                while at < end or number == 0:
                    window = data[at : min(end, at + 4 * frame_units)]
                    starts = np.flatnonzero((window & 0xC0) != 0x80)
                    stop = at + (int(starts[frame_units]) if len(starts) > frame_units else len(window))
                    owner.append(row)
                    numbers.append(number)
                    firsts.append(number * frame_units)
                    units.append(min(len(starts), frame_units))
                    frames.append(packer.compress(data[at:stop].tobytes()))
                    at, number = stop, number + 1
            rest = batch.drop_columns([text])
            for low in range(0, len(owner), _ROWS):
                part = slice(low, low + _ROWS)
                kept = rest.take(pa.array(owner[part], pa.int64()))
                new = [pa.array(numbers[part], pa.int32()), pa.array(firsts[part], pa.int64()), pa.array(units[part], pa.int32()), pa.array(frames[part], pa.binary())]
                yield _batch([*kept.columns, *new], schema)

    return texts.mapInArrow(task, schema)


def select_units(frames: DataFrame, low: str, high: str, literal: str) -> DataFrame:
    """``frame`` and ``units`` cut to the code points from ``low`` to ``high`` of each frame.

    A frame that is wanted whole is passed on as it is, unopened. Where ``literal`` is not null the frame becomes that text.
    """
    schema = _with(frames.schema, "", (low, high, literal))

    def cut(packer, opener, frame: bytes, units: int, first: int, last: int, said: str | None) -> tuple[bytes, int]:
        if said is not None:
            return packer.compress(said.encode()), len(said)
        if first == 0 and last == units:
            return frame, units
        body = opener.decompress(frame)
        starts = np.flatnonzero((np.frombuffer(body, np.uint8) & 0xC0) != 0x80)
        edges = np.append(starts, len(body))
        return packer.compress(body[edges[first] : edges[last]]), last - first

    def task(batches):
        packer, opener = zstandard.ZstdCompressor(level=_LEVEL), zstandard.ZstdDecompressor()
        for batch in batches:
            asked = zip(*(batch.column(c).to_pylist() for c in ("frame", "units", low, high, literal)))
            done = [cut(packer, opener, *x) for x in asked]
            new = {"frame": pa.array([x[0] for x in done], pa.binary()), "units": pa.array([x[1] for x in done], pa.int32())}
            yield _batch([new.get(f.name, batch.column(f.name) if f.name not in new else None) for f in schema], schema)

    return frames.mapInArrow(task, schema)


def fim_plan(key: Column, n: Column, marked: Column) -> dict[str, Column]:
    """``form``, ``cut1`` and ``cut2`` of a text of ``n`` code points; the cuts are null in plain form.

    The digest of the key as decimal text decides; a null key counts as empty text. ``marked`` says that the text holds a sentinel.
    """
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h1, h2, h3, h4 = (F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4))
    plain = (n == 0) | marked | (h3 % 100 >= 90)
    first, second = h1 % (n + 1), h2 % (n + 1)
    return {
        "form": F.when(plain, "plain").when(h4 % 100 < 20, "spm").otherwise("psm"),
        "cut1": F.when(~plain, F.least(first, second)),
        "cut2": F.when(~plain, F.greatest(first, second)),
    }


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", frame_units: int = FRAME_UNITS) -> DataFrame:
    """The transformed texts as frames: (row, key, n, form, cut1, cut2, place, frame_no, units, frame).

    ``row`` numbers the input rows, so that rows that are equal or share a key stay apart. The frames of a row lie in one partition in
    the order of the output, which is (place, frame_no). Sentinels are frames of their own. Null texts count as empty and null
    keys as empty text; other columns are left out; an empty table gives no rows.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    marked = body.contains(PREFIX) | body.contains(SUFFIX) | body.contains(MIDDLE)
    rows = docs.select(F.col(key).alias("key"), body.alias("text"))
    rows = rows.select("key", F.monotonically_increasing_id().alias("row"), F.length("text").cast("long").alias("n"), marked.alias("marked"), "text")
    frames = to_frames(rows, "text", frame_units).withColumns(fim_plan(F.col("key"), F.col("n"), F.col("marked")))

    spm = F.col("form") == "spm"
    places = {
        "prefix": F.when(spm, 3).otherwise(1), "suffix": F.when(spm, 1).otherwise(3), "middle": F.lit(5),
        PREFIX: F.when(spm, 2).otherwise(0), SUFFIX: F.when(spm, 0).otherwise(2), MIDDLE: F.lit(4),
    }
    start, units = F.col("first_unit"), F.col("units")

    def piece(place: Column, low: Column, high: Column, literal: Column) -> Column:
        return F.struct(place.cast("int").alias("place"), low.cast("int").alias("low"), high.cast("int").alias("high"), literal.cast("string").alias("literal"))

    def between(place: Column, low: Column, high: Column) -> Column:
        """The part of the frame inside the code points ``low`` to ``high`` of the text."""
        return piece(place, F.greatest(low - start, F.lit(0)), F.least(high - start, units), F.lit(None))

    ranges = [between(places["prefix"], F.lit(0), F.col("cut1")), between(places["middle"], F.col("cut1"), F.col("cut2")), between(places["suffix"], F.col("cut2"), F.col("n"))]
    said = [piece(places[name], F.lit(0), F.lit(0), F.lit(name)) for name in _SENTINELS]
    pieces = F.filter(F.array(*ranges), lambda p: p["low"] < p["high"])
    pieces = F.when(F.col("frame_no") == 0, F.concat(pieces, F.array(*said))).otherwise(pieces)
    whole = F.array(piece(F.lit(0), F.lit(0), units, F.lit(None)))
    pieces = F.when(F.col("form") == "plain", whole).otherwise(pieces)
    kept = ["row", "key", "n", "form", "cut1", "cut2"]
    pieces = frames.select(*kept, "frame_no", "units", "frame", F.explode(pieces).alias("piece")).select(*kept, "piece.*", "frame_no", "units", "frame")
    out = select_units(pieces, "low", "high", "literal")
    return out.sortWithinPartitions("row", "place", "frame_no")


def fim_digests(output: DataFrame) -> DataFrame:
    """(row, key, n, form, cut1, cut2, output_sha256, restored_sha256) of transformed texts.

    Frames are opened one at a time in the order of the output. The restored text comes from the output and its form alone:
    sentinels in the stream say which part follows, and the parts are then read in the order of the original.
    """
    ids = StructType([f for f in output.schema if f.name in ("row", "key", "n", "form", "cut1", "cut2")])
    parts = StructType(ids.fields + StructType.fromDDL("part int, no long, frame binary, output_sha256 string").fields)

    def stream(batches):
        """Frames with the part of the original that they belong to; after those of a row, its digest as part 3."""
        opener = zstandard.ZstdDecompressor()
        row, held, digest, part, number = None, None, None, 0, 0
        made: list[tuple] = []
        for batch in batches:
            table = batch.to_pydict()
            rows = table["row"]
            for i in range(batch.num_rows):
                if rows[i] != row:
                    if row is not None:
                        made.append((*held, 3, number, None, digest.hexdigest()))
                    row, held, digest, part, number = rows[i], tuple(table[f.name][i] for f in ids), hashlib.sha256(), 0, 0
                body = opener.decompress(table["frame"][i])
                digest.update(body)
                named = _SENTINELS.get(body.decode()) if len(body) == 3 and table["form"][i] != "plain" else None
                if named is not None:
                    part = named
                else:
                    made.append((*held, part, number, table["frame"][i], None))
                number += 1
            yield from flush(made, parts)
        if row is not None:
            made.append((*held, 3, number, None, digest.hexdigest()))
            yield from flush(made, parts)

    final = StructType(ids.fields + StructType.fromDDL("output_sha256 string, restored_sha256 string").fields)

    def restored(batches):
        opener = zstandard.ZstdDecompressor()
        digest, made = hashlib.sha256(), []
        for batch in batches:
            table = batch.to_pydict()
            for i in range(batch.num_rows):
                if table["part"][i] < 3:
                    digest.update(opener.decompress(table["frame"][i]))
                else:
                    made.append((*(table[f.name][i] for f in ids), table["output_sha256"][i], digest.hexdigest()))
                    digest = hashlib.sha256()
            yield from flush(made, final)

    def flush(made: list[tuple], schema: StructType):
        from pyspark.sql.pandas.types import to_arrow_schema

        while made:
            part, made[:_ROWS] = made[:_ROWS], []
            columns = [pa.array(list(c), t.type) for c, t in zip(zip(*part), to_arrow_schema(schema))]
            yield _batch(columns, schema)

    return output.mapInArrow(stream, parts).sortWithinPartitions("row", "part", "no").mapInArrow(restored, final)
