"""Secrets in every version of every path, through a ledger of blobs already scanned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import materialized

# The patterns of the contract and the least lengths.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
# A match of AKIA[A-Z0-9]+ or [0-9a-f]+ ends with its run, and what starts later in the run
# is shorter. So leaving out short matches beforehand finds the same ones.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex")
RULES = "base-1"


def _spans(text: Column, kind: int, pattern: str, value_group: int = 0, value_length: int = 0) -> Column:
    """Matches with their places: lengths of the texts between matches and of the matches, summed up."""
    rule = F.lit(pattern)
    found = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, rule, F.lit(0)), F.length).alias("size"),
        F.transform(F.regexp_extract_all(text, rule, F.lit(value_group)), F.length).alias("value"),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int>>").alias("out"))

    def step(state: Column, match: Column) -> Column:
        begin = state["at"] + match["gap"]
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), (begin + match["size"]).alias("end"))
        out = F.when(match["value"] >= value_length, F.array_append(state["out"], span)).otherwise(state["out"])
        return F.struct((begin + F.coalesce(match["size"], F.lit(0))).alias("at"), out.alias("out"))

    spans = F.aggregate(found, start, step, lambda state: state["out"])
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int>>"))


def secret_spans(text: Column) -> Column:
    """Spans of all kinds by start, then kind; null counts as the empty text."""
    text = F.coalesce(text, F.lit(""))
    return F.array_sort(
        F.concat(_spans(text, 0, ASSIGN, 2, ASSIGN_VALUE), _spans(text, 1, ACCESS), _spans(text, 2, HEX))
    )


def scan_unseen(versions: DataFrame, ledger: DataFrame | None = None, rules: str = RULES, text: str = "text") -> DataFrame:
    """Ledger rows (blob, rules, spans) of the blobs that the ledger lacks for these rules.

    A blob is a distinct text, named by its SHA-256. Copies meet in partial aggregation, so
    that a text with any number of versions is moved and scanned once.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    blobs = versions.select(F.sha2(content.cast("binary"), 256).alias("blob"), content.alias("_text"))
    if ledger is not None:
        blobs = blobs.join(ledger.where(F.col("rules") == rules).select("blob"), "blob", "left_anti")
    blobs = blobs.groupBy("blob").agg(F.first("_text").alias("_text"))
    return blobs.select("blob", F.lit(rules).alias("rules"), secret_spans(F.col("_text")).alias("spans"))


def find_secrets(
    versions: DataFrame, ledger: DataFrame | None = None, rules: str = RULES, text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Every version with its ``blob`` and ``secret_spans``, and the ledger after the scan.

    Versions keep their columns. Null and empty texts are the empty blob without spans;
    repeated rows stay repeated; an empty table gives no rows. Columns named ``blob`` or
    ``secret_spans`` are replaced.
    """
    fresh = materialized(scan_unseen(versions, ledger, rules, text), "ledger")
    known = fresh if ledger is None else ledger.unionByName(fresh)
    blob = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    spans = known.where(F.col("rules") == rules).select("blob", F.col("spans").alias("secret_spans"))
    return versions.drop("secret_spans").withColumn("blob", blob).join(spans, "blob"), known


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span replaced; of overlapping spans one mark stays."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        before = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        fresh = span["start"] >= state["at"]
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(fresh, F.concat(state["out"], before, F.lit(mark))).otherwise(state["out"]).alias("out"),
        )

    return F.aggregate(spans, start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))


def span_names(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind)))
