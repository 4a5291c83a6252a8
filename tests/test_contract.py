"""Every registered query beside its SQL on the smallest tables, and the plans' shape."""

import glob
import os

import pytest

pytest.importorskip("duckdb")
import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
import contract  # noqa: E402
from tools.check import TYPES, normalized  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(contract.QUERIES) == set(contract.ORACLES)


def executed_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, database, name):
    df = entry.queries()[name](spark, FOLDER)
    result = database.execute(entry.oracle_sql()[name])
    columns = {c[0]: str(c[1]) for c in result.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == columns
    plan = executed_plan(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert normalized(df.columns, [tuple(r) for r in df.collect()]) == normalized(list(columns), result.fetchall())


@pytest.mark.parametrize("name", ["html_items", "chunk_records", "hash_embed", "low_score_pages", "chunk_stats"])
def test_document_work_needs_no_shuffle(spark, name, monkeypatch):
    import contract.conversion
    import contract.embedding

    for module in (contract.conversion, contract.embedding):
        monkeypatch.setattr(module, "spread_table", lambda s, f, t, key: contract.table(s, f, t))
    plan = executed_plan(entry.queries()[name](spark, FOLDER))
    assert "Exchange" not in plan
    assert plan.count("&nbsp;") <= 1


@pytest.mark.parametrize("name", sorted(set(contract.QUERIES) - set(contract.ORACLES)))
def test_queries_without_sql_give_rows(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
