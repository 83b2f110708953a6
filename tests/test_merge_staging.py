from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from martloom.operators import merge as M
from martloom.sinks.layout import save_hashed
from martloom.sinks.loads import load_all, load_full, load_order, run_copies, staged
from martloom.sinks.staging import StagingTable
from martloom.specs import INT, LONG, ORDER_REVIEWS, SOURCE_TABLES, TEXT, Reference, TableSpec

SPEC = TableSpec("t", dict(k=TEXT, v=INT), key=("k",))


def found(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols or df.columns).collect()), key=repr)


@pytest.fixture
def kv(rows):
    return lambda *data: rows(list(data), "k string, v int")


def test_insert_if_absent(kv):
    target, batch = kv(("a", 1)), kv(("a", 9), ("b", 5), ("b", 3), ("c", None))
    once = M.insert_if_absent(target, batch, ["k"])
    assert found(once) == [("a", 1), ("b", 3), ("c", None)]
    assert found(M.insert_if_absent(once, batch, ["k"])) == found(once)


def test_upsert(rows, kv):
    target = rows([("a", 1, "old"), ("b", 2, "old")], "k string, v int, derived string")
    batch = kv(("b", None), ("c", 7))
    once = M.upsert(target, batch, ["k"], ["v"])
    assert found(once) == [("a", 1, "old"), ("b", None, "old"), ("c", 7, None)]
    assert found(M.upsert(once, batch, ["k"], ["v"])) == found(once)
    untouched = M.upsert(target, batch, ["k"], [])
    assert found(untouched) == [("a", 1, "old"), ("b", 2, "old"), ("c", 7, None)]


def test_upsert_refuses_a_repeated_key(kv):
    target, batch = kv(("a", 1)), kv(("a", 2), ("a", 3))
    with pytest.raises(Exception, match="key given twice in one batch: a"):
        M.upsert(target, batch, ["k"], ["v"]).collect()
    assert found(M.upsert(target, batch, ["k"], ["v"], on_dup="smallest")) == [("a", 2)]


def test_append_distinct_doubles(kv):
    batch = kv(("a", 1), ("a", 1), ("b", 2))
    twice = M.append_distinct(M.append_distinct(kv(("z", 0)).limit(0), batch), batch)
    assert found(twice) == [("a", 1), ("a", 1), ("b", 2), ("b", 2)]


CHANGES = [
    ("create", 1, "a", 1),
    ("update", 2, "a", 2),
    ("delete", 3, "a", None),
    ("create", 1, "b", 1),
    ("delete", 4, "b", None),
    ("update", 2, "b", 9),  # older than the delete
    ("delete", 5, "old", None),  # key change of `old`: delete and create
    ("create", 6, "new", 3),
    ("create", 6, "new", 3),  # repeated row
    ("update", 7, "kept", None),
]
CHANGE_SCHEMA = "op string, seq long, k string, v int"


def test_apply_changes(rows, kv):
    target = kv(("old", 3), ("kept", 1), ("other", 8))
    for n in (1, 6):
        changes = rows(CHANGES, CHANGE_SCHEMA).repartition(n)
        after = M.apply_changes(target, changes, ["k"], ["seq"], "op")
        assert found(after) == [("kept", None), ("new", 3), ("other", 8)]


def test_staging_keeps_the_last_row(spark, kv, tmp_path):
    table = StagingTable.of(str(tmp_path / "t"), SPEC)
    assert found(table.current(spark)) == []
    table.create_if_absent(spark)
    table.create_if_absent(spark)
    assert found(table.current(spark)) == []
    table.upsert(kv(("a", 1), ("b", 1)))
    table.upsert(kv(("b", 2), ("c", 2)))
    table.upsert(kv())
    table.create_if_absent(spark)
    assert found(table.current(spark)) == [("a", 1), ("b", 2), ("c", 2)]


def test_a_repeated_write_keeps_its_place(spark, kv, tmp_path):
    """Also when a later write replaced all of its rows, or when it was written in part."""
    table = StagingTable.of(str(tmp_path / "t"), SPEC)
    first = kv(("a", 1), ("b", 1)).withColumn("_arrival", F.lit(1000).cast("long"))
    table.upsert(first.where("k = 'a'"))
    table.upsert(kv(("a", 2)))
    for _ in range(2):
        table.upsert(first)
        assert found(table.current(spark)) == [("a", 2), ("b", 1)]


def test_untouched_buckets_keep_their_files(spark, kv, tmp_path):
    table = StagingTable.of(str(tmp_path / "t"), SPEC, buckets=8)
    numbers = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    table.upsert(numbers)

    def files():
        return {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}

    before = files()
    table.upsert(kv(("7", 2)))
    after = files()
    touched = {p.parent for p in before.keys() ^ after.keys()}
    assert len(touched) == 1 and len({p.parent for p in before}) == 8
    assert all(after[p] == t for p, t in before.items() if p.parent not in touched)
    assert dict(table.current(spark).groupBy("v").count().collect()) == {1: 999, 2: 1}


def test_a_write_reads_the_touched_buckets_only(spark, kv, tmp_path):
    table = StagingTable.of(str(tmp_path / "t"), SPEC, buckets=8)
    table.upsert(spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v")))
    plan = table._stored_rows(spark).where("_bucket in (3)")._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(_bucket" in plan.toString()


def test_the_number_of_buckets_is_the_tables(spark, tmp_path):
    numbers = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    StagingTable.of(str(tmp_path / "t"), SPEC, buckets=8).upsert(numbers)
    for count in (5, None):
        other = StagingTable.of(str(tmp_path / "t"), SPEC, buckets=count)
        other.upsert(numbers.withColumn("v", F.lit(count or 0)))
        assert other.current(spark).count() == 1000
        assert {r.v for r in other.current(spark).collect()} == {count or 0}
    assert len(list((tmp_path / "t").glob("_buckets=8/_bucket=*"))) == 8
    assert len(list((tmp_path / "t").glob("_buckets=*"))) == 1


def test_a_hot_key_is_one_row(spark, rows, tmp_path):
    table = StagingTable.of(str(tmp_path / "t"), SPEC, seq=("v",))
    hot = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").cast("int").alias("v"),
    )
    for _ in range(2):
        table.upsert(hot)
        assert table.current(spark).count() == 2001
        assert table.current(spark).where("k = 'hot'").first().v == 2997


def test_null_keys_are_refused(spark, kv, tmp_path):
    table = StagingTable.of(str(tmp_path / "t"), SPEC)
    with pytest.raises(Exception, match="NULL in the key"):
        table.upsert(kv(("a", 1), (None, 2)))
    table.create_if_absent(spark)
    assert found(table.current(spark)) == []


def test_staging_tombstones(spark, rows, tmp_path):
    schema = rows([], "k string, seq long, v int").schema
    table = StagingTable(str(tmp_path / "t"), schema, ("k",), ("seq",), buckets=1)
    batch = lambda *data: rows(list(data), "k string, seq long, v int, _deleted boolean")
    table.upsert(batch(("a", 5, 1, False), ("b", 5, 1, False)))
    table.upsert(batch(("a", 7, None, True)))
    table.upsert(batch(("a", 6, 9, False), ("b", 4, 9, False)))
    assert found(table.current(spark)) == [("b", 5, 1)]
    table.forget_deleted(spark)
    assert found(table.current(spark)) == [("b", 5, 1)]
    table.upsert(batch(("a", 6, 9, False)))
    assert found(table.current(spark)) == [("a", 6, 9), ("b", 5, 1)]


def test_load_order_puts_parents_first():
    order = load_order(SOURCE_TABLES.values())
    assert sorted(order) == sorted(SOURCE_TABLES)
    for spec in SOURCE_TABLES.values():
        for ref in spec.references:
            assert order.index(ref.parent) < order.index(spec.name)


def test_full_refresh(spark, kv, tmp_path):
    path = str(tmp_path / "t")
    assert load_full(kv(("a", 1), ("b", 2)), path) == 2
    assert load_full(kv(("c", 3)), path) == 1
    assert found(spark.read.parquet(path)) == [("c", 3)]


def test_load_all_keeps_earlier_tables(spark, rows, kv, tmp_path):
    child = TableSpec("a_child", dict(k=TEXT, w=LONG), ("k",), references=(Reference(("k",), "t", ("k",)),))
    specs = {"a_child": child, "t": SPEC}
    bad = rows([("a",)], "k string").select("k", F.raise_error(F.lit("boom")).cast("long").alias("w"))
    with pytest.raises(Exception, match="boom"):
        load_all({"a_child": bad, "t": kv(("a", 1))}, str(tmp_path), specs)
    assert found(spark.read.parquet(str(tmp_path / "t"))) == [("a", 1)]


def test_run_copies(spark, kv, tmp_path):
    def read(spec):
        if spec.name == "bad":
            return kv(("a", 1)).withColumn("v", F.raise_error(F.lit("broken")).cast("int"))
        return kv(("a", 1), ("b", 2), ("b", 3)) if spec.name == "good" else kv(("a", 1), ("a", 1))

    specs = {
        name: TableSpec(name, SPEC.types, SPEC.key) for name in ("bad", "good", "twice")
    }
    order = {"good": ("v",)}
    report = {
        r.table_name: r
        for r in run_copies(spark, read, str(tmp_path), specs=specs, order=order).collect()
    }
    assert report["twice"].status == "FAILED" and "key given twice" in report["twice"].error
    assert report["bad"].status == "FAILED" and "broken" in report["bad"].error
    assert (report["good"].status, report["good"].n_rows) == ("OK", 3)
    named = run_copies(
        spark, read, str(tmp_path), ["good", "none"], specs, order=order
    ).collect()
    assert [(r.table_name, r.status) for r in named] == [("good", "OK"), ("none", "FAILED")]
    assert found(StagingTable.of(str(tmp_path / "good"), specs["good"]).current(spark)) == [
        ("a", 1),
        ("b", 3),
    ]


def test_copies_with_another_key_raw_text_and_buckets(spark, rows, tmp_path):
    spec = TableSpec("r", dict(k=TEXT, t=TEXT), ("k",), free_text=("t",))
    data = rows([("a", "x\ty"), ("a", "z")], "k string, t string")
    report = run_copies(
        spark, lambda s: data, str(tmp_path), specs={"r": spec}, raw=["r"], keys={"r": ("k", "t")},
        buckets=4,
    ).first()
    assert (report.status, report.n_rows) == ("OK", 2)
    table = StagingTable.of(f"{tmp_path}/r", spec, keys=("k", "t"))
    assert found(table.current(spark)) == [("a", "x\ty"), ("a", "z")]
    assert {p.name for p in (tmp_path / "r").glob("_buckets=*")} == {"_buckets=4"}


def test_star_tables_are_hashed_by_key(spark, rows, tmp_path):
    spec = TableSpec("dim", dict(d_key=INT, name=TEXT), ("d_key",))
    frame = rows([(1, "a"), (2, "b")], "d_key int, name string")
    assert load_all({"dim": frame}, str(tmp_path), {"dim": spec}, buckets=4, prefix="hashed_t_") == {"dim": 2}
    assert spark.table("hashed_t_dim").count() == 2
    assert "4" in str(spark.sql("DESCRIBE EXTENDED hashed_t_dim").where("col_name = 'Num Buckets'").first())


def test_empty_tables_are_counted(spark, kv, tmp_path):
    empty = kv().limit(0)
    assert load_full(empty, str(tmp_path / "full")) == 0
    report = run_copies(spark, lambda spec: empty, str(tmp_path), specs={"t": SPEC}).first()
    assert (report.status, report.n_rows) == ("OK", 0)


def test_staged_reviews(rows):
    df = rows(
        [("r", "o", 5, "t\tt", "m\r\n" + "x" * 300)],
        "review_id string, order_id string, review_score int, review_comment_title string,"
        " review_comment_message string",
    ).withColumns(
        {c: F.lit(None).cast("timestamp_ntz") for c in ("review_creation_date", "review_answer_timestamp")}
    )
    clean = staged(df, ORDER_REVIEWS).first()
    assert clean.review_comment_title == "t t"
    assert clean.review_comment_message == "m  " + "x" * 252
    assert staged(df, ORDER_REVIEWS, raw=True).first().review_comment_title == "t\tt"
    wide = replace(ORDER_REVIEWS, limits={"review_comment_message": 65533})
    assert len(staged(df, wide).first().review_comment_message) == 303


def test_other_tables_are_copied_as_they_are(kv):
    long_text = "a\t" + "x" * 300
    assert found(staged(kv((long_text, 1)), SPEC)) == [(long_text, 1)]


def test_hashed_tables_join_without_shuffle(spark, tmp_path):
    base = spark.range(5000).select(F.col("id").cast("string").alias("k"), "id")
    left = save_hashed(base, "hashed_left", ["k"], 4, str(tmp_path / "l"))
    right = save_hashed(base.select("k", (F.col("id") * 2).alias("twice")), "hashed_right", ["k"], 4,
                        str(tmp_path / "r"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left.join(right, "k")
        assert joined.where("twice = id * 2").count() == 5000
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
