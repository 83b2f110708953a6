import random
import time
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martloom.operators.history import asof_join, valid_at, validity
from martloom.operators.pages import with_child_pages
from martloom.operators.quality import check_table
from martloom.plans.reports import running_total, sales_rollup
from martloom.sinks.loads import checked_load
from martloom.sinks.staging import StagingTable
from martloom.sources.change_log import ChangeLogReader, read_change_log
from martloom.sources.changes import change_schema
from martloom.specs import DOUBLE, INT, LONG, TEXT, TIME, Reference, TableSpec
from martloom.streaming.state import newest_changes, stream_apply_newest, window_totals
from martloom.streaming.upsert import stream_changes

DAY0 = datetime(2024, 1, 1)


def at(hours):
    return None if hours is None else DAY0 + timedelta(hours=hours)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- nested children -------------------------------------------------------------------------


def test_a_parent_of_a_third_of_all_children_is_many_pages(spark, rows):
    parents = rows([(i, f"p{i}") for i in range(50)] + [(None, "none")], "id long, name string")
    children = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") == 1, None).when(F.col("id") == 2, 999)
        .otherwise(F.col("id") % 40).alias("id"),
        (5000 - F.col("id")).alias("n"), F.concat(F.lit("c"), "id").alias("name"),
    )
    got = with_child_pages(parents, children, "id", "items", ["n"], page_rows=100)
    assert got.columns == ["id", "name", "page", "items"]
    assert got.schema["items"].dataType.elementType.names == ["n", "name"]
    data = got.collect()
    assert max(len(r["items"]) for r in data) == 100
    given = {}
    for r in children.collect():
        given.setdefault(r.id, []).append((r.n, r.name))
    hot = sorted((r for r in data if r.id == 7), key=lambda r: r.page)
    assert [r.page for r in hot] == list(range(-(-len(given[7]) // 100)))
    for r in [None, *range(50)]:
        pages = sorted((x for x in data if x.id == r), key=lambda x: x.page)
        listed = [tuple(i) for x in pages for i in x["items"]]
        assert listed == (sorted(given.get(r, [])) if r is not None else [])
        assert pages and pages[0].page == 0


def test_pages_of_no_children(rows):
    parents = rows([(1,), (2,)], "id long")
    children = rows([], "parent long, n long")
    got = with_child_pages(parents, children, "id", "items", ["n"], child_on="parent")
    assert found(got) == [(1, 0, []), (2, 0, [])]


# --- loads with checks -----------------------------------------------------------------------


def test_checked_load_counts_what_check_table_counts(spark, rows, tmp_path):
    spec = TableSpec(
        "items", dict(id=TEXT, product=TEXT, n=INT), ("id",), nullable=frozenset(["product"]),
        references=(Reference(("product",), "products", ("p",)),), limits=dict(id=3),
    )
    data = rows(
        [("a", "x", 1), ("abcd", "y", None), (None, None, 2), *[("h", "gone", 3)] * 40],
        "id string, product string, n int",
    )
    parents = {"products": rows([("x",), ("y",), ("y",)], "p string")}
    report = checked_load(data, str(tmp_path / "t"), spec, parents)
    expected = check_table(data, spec, parents).where("check_name <> 'key'")
    assert found(report) == found(expected)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 43
    report = checked_load(data.limit(0), str(tmp_path / "t"), spec, parents)
    assert {r.n_violations for r in report.collect()} == {0}


# --- joins in time ---------------------------------------------------------------------------


def histories(seed):
    choose = random.Random(seed)
    keys = ["hot", "hot", "a", "b", None]
    hour = lambda: choose.choice([None, *range(200)]) if choose.random() < 0.1 else choose.randrange(200)
    left = [(i, choose.choice(keys), at(hour())) for i in range(150)]
    right = [(choose.choice(keys), at(hour()), i) for i in range(120)]
    return left, right


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_asof_join(rows, seed, kind):
    left, right = histories(seed)
    got = asof_join(
        rows(left, f"id long, k string, t {kind}"), rows(right, f"k string, s {kind}, v long"), ["k"], "t", "s"
    )
    assert got.columns == ["id", "k", "t", "s", "v"]
    expected = []
    for number, key, time in left:
        fit = [(s, v) for k, s, v in right if None not in (k, s, key, time) and k == key and s <= time]
        expected.append((number, key, time, *max(fit, default=(None, None))))
    assert found(got) == sorted(expected, key=repr)


def test_asof_join_sorts_no_whole_history(rows):
    left, right = histories(3)
    left, right = rows(left, "id long, k string, t timestamp_ntz"), rows(right, "k string, s timestamp_ntz, v long")
    plan = plan_of(asof_join(left, right, ["k"], "t", "s"))
    windows = [line for line in plan.splitlines() if " Window [" in line or "Window [" in line.strip()]
    assert windows and all("_bucket" in line for line in windows)
    with pytest.raises(ValueError, match="both sides"):
        asof_join(left, right.withColumnRenamed("v", "id"), ["k"], "t", "s")


@pytest.mark.parametrize("seed", [1, 2])
def test_validity_and_the_row_valid_at_a_time(rows, seed):
    left, right = histories(seed)
    changes = rows(
        [(k, s, v, v % 5 == 0) for k, s, v in right], "k string, s timestamp_ntz, v long, gone boolean"
    )
    history = validity(changes, ["k"], "s", "v", F.col("gone"))
    expected = []
    usable = sorted((k, s, v) for k, s, v in right if None not in (k, s))
    for n, (k, s, v) in enumerate(usable):
        following = next((x[1] for x in usable[n + 1 : n + 2] if x[0] == k), None)
        if v % 5 and (following is None or following > s):
            expected.append((k, s, v, False, s, following))
    assert found(history) == sorted(expected, key=repr)
    facts = rows(left, "id long, k string, t timestamp_ntz")
    got = valid_at(
        facts, history.select("k", "v", "valid_from", "valid_to"), ["k"], "t", F.lit(at(200)), 36 * 3600
    )
    joined = [
        (number, key, time, *next(
            ((v, s, e) for k, s, v, _, _, e in expected
             if None not in (key, time) and k == key and s <= time and (e is None or time < e)),
            (None, None, None),
        ))
        for number, key, time in left
    ]
    assert found(got) == sorted(joined, key=repr)


# --- reports ---------------------------------------------------------------------------------


def test_running_total(spark):
    df = spark.range(2000).select(
        (F.col("id") * 7919 % 2000).alias("n"), (F.col("id") % 13).cast("decimal(12,2)").alias("v")
    ).withColumn("v", F.when(F.col("n") % 10 > 0, F.col("v")))
    got = running_total(df, ["n"], F.col("v"), "total")
    assert "SinglePartition" not in plan_of(got).replace("BroadcastExchange SinglePartition", "")
    total, expected = Decimal(0), []
    for r in sorted(df.collect()):
        total += r.v or 0
        expected.append((r.n, r.v, total))
    assert sorted(map(tuple, got.collect())) == expected
    assert running_total(df.limit(0), ["n"], F.col("v"), "total").count() == 0


def test_rollup_levels(rows):
    fact = rows(
        [("o1", 1, "10", "1"), ("o1", 2, "5", "1"), ("o2", 1, "2", "0"), ("o2", 9, "1", "0")],
        "order_id string, product_key int, p string, f string",
    ).select("order_id", "product_key", F.col("p").cast("decimal(12,2)").alias("item_price"),
             F.col("f").cast("decimal(12,2)").alias("freight_value"))
    orders = rows([("o1", at(0)), ("o2", at(24 * 40))], "order_id string, order_purchase_timestamp timestamp_ntz")
    products = rows([(1, "toys"), (2, "toys")], "product_key int, product_category string")
    days = rows([(20240101, 2024, 1, 1), (20240210, 2024, 1, 2)], "date_id int, year int, quarter int, month int")
    got = {
        (r.level, r.month, r.product_category): (r.n_lines, r.price, r.freight)
        for r in sales_rollup(fact, orders, products, days).collect()
    }
    assert got[15, None, None] == (4, 18, 2) and got[7, None, None] == got[3, None, None] == (4, 18, 2)
    assert got[1, 1, None] == (2, 15, 2) and got[0, 1, "toys"] == (2, 15, 2)
    assert got[0, 2, "toys"] == (1, 2, 0) and got[0, 2, None] == (1, 1, 0)


# --- streams with state ----------------------------------------------------------------------

SPEC = TableSpec("t", dict(k=TEXT, v=INT), key=("k",))


def test_state_keeps_late_changes_back(spark, tmp_path):
    """Over several micro-batches and a restart; the target has no sequence."""
    source, target = str(tmp_path / "in"), StagingTable.of(str(tmp_path / "t"), SPEC)
    batches = [
        [("create", 5, "a", 1), ("create", 1, "b", 1), ("update", 3, "b", 2), ("create", None, "c", 9)],
        [("delete", 8, "a", None), ("update", 2, "b", 7), ("create", 4, None, 1)],
        [("update", 7, "a", 5), ("update", 9, "b", 3), ("create", 1, "d", 4)],
    ]
    expected = [[("a", 1), ("b", 2)], [("b", 2)], [("b", 3), ("d", 4)]]
    for data, rows_left in zip(batches, expected):
        spark.createDataFrame(data, change_schema(SPEC)).coalesce(1).write.mode("append").parquet(source)
        stream = stream_changes(spark, SPEC, source)
        stream_apply_newest(stream, target, str(tmp_path / "cp"), available_now=True).awaitTermination()
        assert found(target.current(spark)) == rows_left
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"
    with pytest.raises(Exception, match="k9"):
        newest_changes(stream_changes(spark, SPEC, source), ["k9"])


def _applied(spark, tmp_path, spec, data, target, **more):
    source = str(tmp_path / "in")
    spark.createDataFrame(data, change_schema(spec)).coalesce(1).write.mode("append").parquet(source)
    stream = stream_changes(spark, spec, source)
    query = stream_apply_newest(stream, target, str(tmp_path / "cp"), available_now=True, **more)
    query.awaitTermination()
    return query.recentProgress


def test_state_is_called_and_kept_by_group(spark, tmp_path):
    """What a call costs is not paid by key: 3000 deleted keys have a value and a timer by group."""
    target = StagingTable.of(str(tmp_path / "t"), SPEC)
    gone = [("delete", i, f"k{i}", None) for i in range(3000)]
    kept = [("create", 5000 + i, f"n{i}", i) for i in range(10)]
    progress = _applied(spark, tmp_path, SPEC, gone + kept, target)
    stored = [p["stateOperators"][0] for p in progress if p["stateOperators"]]
    assert stored and max(p["numRowsTotal"] for p in stored) < 3000
    assert found(target.current(spark)) == [(f"n{i}", i) for i in range(10)]
    late = [("update", 1, f"k{i}", 1) for i in range(2, 3000)] + [("update", 6000, "k7", 7)]
    _applied(spark, tmp_path, SPEC, late, target)
    assert found(target.current(spark)) == sorted([("k7", 7), *((f"n{i}", i) for i in range(10))])


def test_state_lets_values_through_as_they_are(spark, tmp_path):
    """Long numbers beside NULL, NaN apart from NULL, keys of several types."""
    spec = TableSpec("t", dict(k=TEXT, at=TIME, n=LONG, d=DOUBLE), key=("k", "at"))
    target, big = StagingTable.of(str(tmp_path / "t"), spec), 2**53 + 1
    _applied(spark, tmp_path, spec, [
        ("create", big, "a", at(0), big, float("nan")), ("create", big - 1, "a", at(0), 1, 1.0),
        ("create", None, "a", at(0), None, None), ("create", 1, "a", at(1), None, None),
    ], target)
    _applied(spark, tmp_path, spec, [
        ("update", big - 1, "a", at(0), 2, 2.0), ("update", 2, "a", at(1), big, None),
    ], target)
    assert [tuple(map(str, r)) for r in found(target.current(spark))] == [
        ("a", str(at(0)), str(big), "nan"), ("a", str(at(1)), str(big), "None"),
    ]


def test_deleted_keys_are_forgotten_after_a_while(spark, tmp_path):
    target = StagingTable.of(str(tmp_path / "t"), SPEC)
    short = dict(tombstone_ms=1, groups=1)
    _applied(spark, tmp_path, SPEC, [("delete", 9, "a", None), ("create", 9, "b", 1)], target, **short)
    time.sleep(0.1)
    # the timer is looked at after the rows of a micro-batch: `a` is still known in this one
    _applied(spark, tmp_path, SPEC, [("update", 5, "a", 5), ("delete", 10, "b", None)], target, **short)
    assert found(target.current(spark)) == []
    _applied(spark, tmp_path, SPEC, [("update", 5, "a", 6), ("create", 11, "b", 2)], target, **short)
    # `b` lives again: its state stays
    _applied(spark, tmp_path, SPEC, [("create", 1, "c", 1)], target, **short)
    _applied(spark, tmp_path, SPEC, [("update", 3, "b", 9), ("update", 4, "a", 9)], target, **short)
    assert found(target.current(spark)) == [("a", 6), ("b", 2), ("c", 1)]
    with pytest.raises(Exception, match="1 groups, not 2"):
        _applied(spark, tmp_path, SPEC, [("update", 30, k, 9) for k in "abcdefghij"], target, groups=2)


def test_windows_drop_late_rows(spark, rows, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "t timestamp_ntz, k string, v long"
    parts = [
        [(at(1), "a", 1), (at(2), "a", 2), (at(30), "b", 5)],
        [(at(3), "a", 4), (at(100), "b", 1), (None, "b", 1)],
        [(at(4), "a", 8), (at(40), "b", 8), (at(90), "a", 16)],
    ]
    for part in parts:
        rows(part, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        totals = window_totals(stream, "t", "1 day", "20 hours", ["k"], [F.sum("v").alias("v")])
        (
            totals.writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
            .awaitTermination()
        )
    # after the second part the mark is at hour 80: what comes for days 0 and 1 is late
    assert found(spark.read.parquet(out)) == [
        (at(0), at(24), "a", 7), (at(24), at(48), "b", 5),
    ]


# --- change files as a data source -----------------------------------------------------------


def test_change_log_goes_on_at_its_offset(spark, tmp_path):
    schema, folder = change_schema(SPEC), tmp_path / "in"
    out = str(tmp_path / "out")

    def run():
        query = (
            read_change_log(spark, f"file:{folder}", SPEC).writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    def arrive(name, data, columns=None):
        df = spark.createDataFrame(data, schema)
        (df.select(*columns) if columns else df).coalesce(1).write.parquet(str(folder / name))

    arrive("00", [("create", 1, "a", 1), ("create", 2, "b", 2)])
    assert run() == 2
    arrive("01", [("delete", 3, "a", None)], ["op", "seq", "k"])  # key only
    arrive("02", [("update", 4, "b", 5), ("update", 5, "b", 6), ("update", 6, "b", 7)])
    assert run() == 4
    assert run() == 0
    assert found(spark.read.parquet(out)) == [
        ("create", 1, "a", 1), ("create", 2, "b", 2), ("delete", 3, "a", None),
        ("update", 4, "b", 5), ("update", 5, "b", 6), ("update", 6, "b", 7),
    ]


def test_change_log_takes_so_many_files_at_a_time(tmp_path):
    for n in range(7):
        (tmp_path / f"{n:03d}").mkdir()
        (tmp_path / f"{n:03d}" / "part-0.parquet").write_bytes(b"")
        (tmp_path / f"{n:03d}" / "_SUCCESS").write_bytes(b"")
    reader = ChangeLogReader(str(tmp_path), change_schema(SPEC), 3)
    start, taken = reader.initialOffset(), []
    for _ in range(3):
        end = reader.latestOffset()
        taken.append([p.name for p in reader.partitions(start, end)])
        start = end
    assert [len(t) for t in taken] == [3, 3, 1]
    assert sorted(sum(taken, [])) == [f"{n:03d}/part-0.parquet" for n in range(7)]
    again = ChangeLogReader(str(tmp_path), change_schema(SPEC), 3)  # as after a restart
    end = again.latestOffset()
    assert [p.name for p in again.partitions({"last": "004/part-0.parquet"}, end)] == [
        "005/part-0.parquet", "006/part-0.parquet",
    ]
