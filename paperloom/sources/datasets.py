"""Record tables in JSON, CSV and Parquet files."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.constants import BLOCK_BYTES, COMBINED_DATASET_NAME
from paperloom.functions.text import dataset_name
from paperloom.operators.bounded import broadcast_if_small
from paperloom.session import materialized
from paperloom.sources.manifest import literal_path

FORMATS = {"json": "json", "jsonl": "json", "csv": "csv", "parquet": "parquet"}


def file_format(path: str) -> str:
    extension = path.rsplit(".", 1)[-1]
    if extension not in FORMATS:
        raise ValueError(f"unknown data format {extension!r}; choose from {sorted(FORMATS)}")
    return FORMATS[extension]


#: Where a row of a text format comes from, as far as Spark tells.
_FILE = "_metadata.file_path"
_BLOCK = "_metadata.file_block_start"
_BROKEN = "_broken"
_CSV = {"header": True, "quote": '"', "escape": '"'}


def _by_layout(spark: SparkSession, paths: list[str], kind: str) -> tuple[list[str], list[str]]:
    """Files that cannot be cut at line ends, JSON arrays and CSV with line breaks inside quotes, and the others.

    One scan of the lines without parsing them. A JSON file that begins with a bracket is an array. A quoted value that
    goes over a line end leaves an odd number of quotes in the line it begins in.
    """
    lines = spark.read.text(paths).select(F.col(_FILE).alias("file"), F.col(_BLOCK).alias("block"), F.monotonically_increasing_id().alias("place"), "value")
    if kind == "json":
        first = F.min_by(F.substring(F.ltrim(F.translate("value", "\t\r\ufeff", " ")), 1, 1), F.struct("block", "place"))
        found = lines.filter(F.col("value").rlike(r"[^\s\ufeff]")).groupBy("file").agg((first == "[").alias("whole"))
    else:
        quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
        found = lines.groupBy("file").agg((F.max(quotes % 2) == 1).alias("whole"))
    files = found.collect()
    return [_plain(f["file"]) for f in files if f["whole"]], [_plain(f["file"]) for f in files if not f["whole"]]


#: A line of JSON without what its strings hold: brackets, commas, names and numbers.
_BARE = r"\\.", r'"[^"]*"'
#: What stands around the records of a line of an array.
_BEFORE, _AFTER = r"^[\s\ufeff]*\[?[\s]*,?", r",?\s*\]?\s*$"


def _array_lines(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those JSON arrays whose lines hold whole records, so that they can be read line by line.

    Strings hold no line ends. Where a line begins and ends with a record and its brackets match, all lines begin between records. The
    opening bracket is in the first line, the closing one in the last, and either all lines but the first begin with a comma
    or all but the last end with one. Any other file, one of a single line too, is left to the parser of whole files.
    """
    bare = F.regexp_replace(F.regexp_replace("value", _BARE[0], ""), _BARE[1], "0")
    bare = F.regexp_replace(F.translate(bare, "\ufeff", " "), r"\s+", "")
    lines = spark.read.text(paths).select(
        F.col(_FILE).alias("file"), F.struct(F.col(_BLOCK).alias("block"), F.monotonically_increasing_id().alias("place")).alias("at"), bare.alias("bare")
    )
    lines = lines.filter("bare <> ''")
    inner = F.regexp_replace(F.regexp_replace("bare", r"^\[", ""), r"\]$", "")
    lines = lines.select("file", "at", F.col("bare").startswith("[").alias("opens"), F.col("bare").endswith("]").alias("closes"), inner.alias("inner"))
    count = lambda mark: F.length("inner") - F.length(F.replace("inner", F.lit(mark), F.lit("")))
    sound = F.col("inner").rlike(r"^(,?\{.*\},?)?$") & ~F.col("inner").rlike("[\"']") & (count("{") == count("}")) & (count("[") == count("]"))
    found = lines.groupBy("file").agg(
        F.bool_and(sound).alias("sound"),
        F.count_if("opens").alias("opened"),
        F.count_if("closes").alias("closed"),
        F.min_by("opens", "at").alias("first"),
        F.max_by("closes", "at").alias("last"),
        F.count_if(F.col("inner") != "").alias("n"),
        F.count_if(F.col("inner").startswith(",")).alias("before"),
        F.count_if(F.col("inner").endswith(",")).alias("after"),
        F.min_by(F.col("inner").startswith(","), F.when(F.col("inner") != "", F.col("at"))).alias("early"),
        F.max_by(F.col("inner").endswith(","), F.when(F.col("inner") != "", F.col("at"))).alias("late"),
    )
    commas = F.expr("(before = n - 1 AND after = 0 AND NOT early) OR (after = n - 1 AND before = 0 AND NOT late)")
    good = found.filter(F.expr("sound AND opened = 1 AND closed = 1 AND first AND last AND n > 1") & commas)
    return [_plain(row["file"]) for row in good.select("file").collect()]


def _read_array_lines(spark: SparkSession, paths: list[str], schema: T.StructType, extra: Sequence[Column]) -> DataFrame:
    """Records of arrays whose lines hold whole records; a broken record is an error."""
    records = F.concat(F.lit("["), F.regexp_replace(F.regexp_replace("value", _BEFORE, ""), _AFTER, ""), F.lit("]"))
    parsed = F.from_json(records, T.ArrayType(schema), {"mode": "FAILFAST"})
    rows = spark.read.text(paths).select(F.explode(parsed).alias("_record"), *extra)
    return rows.select("_record.*", *[name for name in rows.columns if name != "_record"])


def _plain(file: str) -> str:
    """A file as Spark names it in results, as a path in which no character stands for others."""
    return literal_path(unquote(file))


def _reader(spark: SparkSession, kind: str, whole: bool, schema: T.StructType | str | None, mode: str):
    reader = spark.read.option("mode", mode).option("columnNameOfCorruptRecord", _BROKEN).option("multiLine", whole)
    if kind == "csv":
        reader = reader.options(inferSchema=schema is None, **_CSV)
    return reader.schema(schema) if schema is not None else reader


def _load(reader, kind: str, paths: list[str]) -> DataFrame:
    return reader.csv(paths) if kind == "csv" else reader.json(paths)


def _one_format(paths: str | Sequence[str]) -> tuple[list[str], str]:
    paths = [paths] if isinstance(paths, str) else list(paths)
    formats = {file_format(path) for path in paths}
    if len(formats) != 1:
        raise ValueError(f"files of one read must share a format, not {sorted(formats)}")
    return paths, formats.pop()


def _parsed(
    spark: SparkSession,
    paths: list[str],
    kind: str,
    schema: T.StructType | str | None,
    multi_line: bool | None,
    mode: str,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Records of JSON or CSV with all columns of ``schema``, files that split and files that do not side by side."""

    def part(files: list[str], whole: bool) -> DataFrame:
        rows = _load(_reader(spark, kind, whole, schema, mode), kind, files)
        return rows.select("*", *extra) if extra else rows

    if multi_line is not None:
        return part(paths, multi_line)
    known = kind == "json" and not any(path.endswith(".json") for path in paths)
    whole, lines = ([], paths) if known else _by_layout(spark, paths, kind)
    arrays = _array_lines(spark, whole) if whole and kind == "json" and mode == "FAILFAST" and schema is not None else []
    if not arrays:
        if not whole or not lines:
            return part(paths, bool(whole))
        return part(whole, True).unionByName(part(lines, False), allowMissingColumns=schema is None)
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = _read_array_lines(spark, arrays, fields, extra)
    for files, multi in (([f for f in whole if f not in arrays], True), (lines, False)):
        rows = rows.unionByName(part(files, multi)) if files else rows
    return rows


def read_dataset(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | str | None = None,
    multi_line: bool | None = None,
    on_error: str = "strict",
) -> DataFrame:
    """Read files of one format, chosen by extension.

    JSON is one record a line, or an array of records in a ``.json`` file; CSV has a header and may hold line breaks and
    doubled quotes. Files whose records end with their lines are split over tasks, arrays among them where a ``schema`` is given and broken
    records are errors; others are one task each. Which is which is found in scans of the lines, unless ``multi_line`` states it for all.

    A record that does not parse is an error. With ``on_error="skip"`` it is left out; :func:`broken_records` lists such records.
    Give a ``schema`` for JSON and CSV when it is known: without one Spark reads the files twice.
    """
    if on_error not in ("strict", "skip"):
        raise ValueError("on_error must be 'strict' or 'skip'")
    paths, kind = _one_format(paths)
    if kind == "parquet":
        return spark.read.parquet(*paths)
    if on_error == "strict":
        return _parsed(spark, paths, kind, schema, multi_line, "FAILFAST")
    full = _with_broken(spark, paths, kind, schema, multi_line)
    return _parsed(spark, paths, kind, full, multi_line, "PERMISSIVE").filter(~_is_broken(full)).drop(_BROKEN)


def _is_broken(full: T.StructType) -> Column:
    """Spark parses only the columns that are asked for, so all are: a record is broken if any of them is."""
    whole = F.to_json(F.struct(*[F.col(name) for name in full.names if name != _BROKEN]))
    return F.col(_BROKEN).isNotNull() & (F.length(whole) >= 0)


def _with_broken(spark, paths, kind, schema, multi_line) -> T.StructType:
    if schema is None:
        schema = _parsed(spark, paths, kind, None, multi_line, "PERMISSIVE").schema
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return T.StructType([f for f in fields if f.name != _BROKEN]).add(_BROKEN, T.StringType())


def broken_records(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | str | None = None,
    multi_line: bool | None = None,
) -> DataFrame:
    """Records that do not parse, as they stand: ``file, record``. Parquet has none."""
    paths, kind = _one_format(paths)
    if kind == "parquet":
        return spark.createDataFrame([], "file string, record string")
    full = _with_broken(spark, paths, kind, schema, multi_line)
    rows = _parsed(spark, paths, kind, full, multi_line, "PERMISSIVE", [F.col(_FILE).alias("_file")])
    return rows.filter(_is_broken(full)).select(F.col("_file").alias("file"), F.col(_BROKEN).alias("record"))


def _source_name() -> Column:
    """Name of the input that a row comes from: the first part of its path that has a known extension, a file or a folder."""
    known = "|".join(FORMATS)
    path = F.url_decode(F.replace("_file", F.lit("+"), F.lit("%2B")))
    return dataset_name(F.regexp_extract(path, rf"/([^/]+\.(?:{known}))(?:/|$)", 1))


def read_datasets(
    spark: SparkSession,
    paths: Sequence[str],
    combine: bool = False,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Several inputs of one format as one table with a ``dataset`` column.

    Combined inputs form one dataset; otherwise each input is its own, named by its path. Inputs agree in column names and
    types, and are one scan whatever their number. Without a ``schema`` each is looked at for its own first.
    """
    return _located(spark, paths, combine, schema).drop("_file", "_start")


def _located(spark: SparkSession, paths: Sequence[str], combine: bool, schema: T.StructType | str | None) -> DataFrame:
    """Records with ``dataset``, ``_file`` and ``_start``, the place in the file that their block begins at."""
    paths, kind = _one_format(paths)
    if schema is None:
        # Parts are analysed, not read: this raises where they disagree.
        schema = concat_datasets([read_dataset(spark, path) for path in paths]).drop("source_pos").schema
    place = [F.col(_FILE).alias("_file"), F.col(_BLOCK).alias("_start")]
    if kind == "parquet":
        rows = spark.read.schema(schema).parquet(*paths).select("*", *place)
    else:
        rows = _parsed(spark, paths, kind, schema, None, "FAILFAST", place)
    return rows.withColumn("dataset", F.lit(COMBINED_DATASET_NAME) if combine else _source_name())


def read_numbered(
    spark: SparkSession,
    paths: Sequence[str],
    combine: bool = False,
    schema: T.StructType | str | None = None,
    key: str = "row_id",
) -> DataFrame:
    """The table of :func:`read_datasets`, stored once, its records numbered from 0 in every ``dataset``.

    Numbers follow file, block and record. Blocks are counted, so that only one small row a block is sorted, and the records
    themselves do not move.
    """
    if len(set(paths)) != len(paths):
        raise ValueError("an input is listed twice")
    placed = _located(spark, list(paths), combine, schema)
    names = [c for c in placed.columns if c not in ("_file", "_start")]
    stored = materialized(placed.withColumn("_place", F.monotonically_increasing_id()), "records")
    blocks = stored.groupBy("dataset", "_file", "_start").agg(F.count("*").alias("_rows"), F.min("_place").alias("_low"))
    earlier = Window.partitionBy("dataset").orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialized(blocks.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows"), "offsets")
    weight = F.octet_length("_file") + F.octet_length("dataset") + 32
    found = stored.join(broadcast_if_small(offsets, weight, BLOCK_BYTES), ["dataset", "_file", "_start"])
    return found.select(*names, (F.col("_before") + F.col("_place") - F.col("_low")).alias(key))


def concat_datasets(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of all parts, duplicates included; ``source_pos`` tells the part.

    Parts must agree in column names and types.
    """
    if not parts:
        raise ValueError("at least one dataset is needed")
    expected = {f.name: f.dataType for f in parts[0].schema}
    result = None
    for number, part in enumerate(parts):
        found = {f.name: f.dataType for f in part.schema}
        if found != expected:
            raise ValueError(f"dataset {number} has another schema: {part.schema.simpleString()}")
        tagged = part.withColumn("source_pos", F.lit(number))
        result = tagged if result is None else result.unionByName(tagged)
    return result


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread an input with fewer splits than the cluster has cores.

    A small file is often a single row group and then a single task. A larger input
    is returned as it is: its own splits occupy every core, and nothing is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def write_dataset(
    df: DataFrame, path: str, extension: str, mode: str = "errorifexists", by: Sequence[str] = ()
) -> None:
    """Write in the format of an input: JSON as lines, CSV with header, or Parquet.

    With ``by`` there is one folder for each value of these columns; a large one has several files.
    """
    kind = file_format(f".{extension}")
    writer = (df.hint("rebalance", *by) if by else df).write.mode(mode).partitionBy(*by)
    if kind == "json":
        writer.option("ignoreNullFields", False).json(path)
    elif kind == "csv":
        writer.options(header=True, quote='"', escape='"').csv(path)
    else:
        writer.parquet(path)
