from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as spark_entry
from compare import differences
from martloom.shared import fresh_path, shared_root, work_tables, written
from martloom.sinks.layout import save_hashed

SF_DIR = "/root/testdata/sf0.001"
ORACLE = spark_entry.oracle_sql()
# queries of an optional folder have tests of their own
QUERIES = {n: q for n, q in spark_entry.queries().items() if ".llm" not in q.__module__ and n != "pipeline"}


# a key's bucket of time, or the rows of one task
WINDOWED = {"asof_events", "user_history", "orders_at_state", "running_sales"}


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for file in sorted(Path(SF_DIR).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    result = con.execute(ORACLE[name])
    cols = [d[0] for d in result.description]
    rows = [tuple(r) for r in df.collect()]
    assert differences(rows, df.columns, result.fetchall(), cols) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert slow not in plan
    assert ("MapInArrow" in plan) == (name in ("score_branches", "branch_loss"))
    # windows only where they are over bounded groups, and never over all rows in one task
    assert ("Window" in plan) == (name in WINDOWED)
    if name in WINDOWED:
        assert "Exchange SinglePartition" not in plan.replace("BroadcastExchange", "")


def test_entry(spark):
    fact = spark_entry.entry(spark)
    assert fact.columns[0] == "order_item_fact_key"
    assert fact.count() > 0


class _Cluster:
    """Enough of a session to ask for the shared folder."""

    def __init__(self, master, root=None, warehouse=None):
        self.master, self.applicationId = master, "app"
        self.given = {"spark.checkpoint.dir": root, "spark.sql.warehouse.dir": warehouse}
        self.conf = self.sparkContext = self

    def get(self, key, default):
        return self.given[key] or default

    def getCheckpointDir(self):
        return None


def test_shared_folder():
    assert shared_root(_Cluster("yarn", "hdfs:///work/")) == "hdfs:///work"
    assert shared_root(_Cluster("yarn", warehouse="s3a://b/wh/")) == "s3a://b/wh"
    assert shared_root(_Cluster("local[2]", warehouse="file:/tmp/wh")) == "file:/tmp/wh"
    for of_one_machine in (None, "file:/tmp/wh", "/tmp/wh"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_root(_Cluster("yarn", warehouse=of_one_machine))


def test_work_tables_go_when_the_results_are_written(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "work")
    monkeypatch.setattr("martloom.shared.work_root", lambda spark: root)
    with work_tables(spark):
        kept = written(spark.range(10).toDF("id"), "kept")
        save_hashed(kept, "hashed_work", ["id"], 4, fresh_path(spark, "hashed"))
        save_hashed(kept, "hashed_other", ["id"], 4, str(tmp_path / "other"))
        assert kept.count() == 10
    assert not Path(root).exists()
    assert not spark.catalog.tableExists("hashed_work") and spark.catalog.tableExists("hashed_other")
    assert spark.table("hashed_other").count() == 10
