import pytest
from pyspark.sql import functions as F

from martloom.operators import quality as Q
from martloom.operators import rows as R
from martloom.specs import DOUBLE, INT, ORDER_ITEMS, SOURCE_TABLES, STAR_TABLES, TEXT, TableSpec


def found(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols or df.columns).collect()), key=repr)


def test_not_null_keeps_nan(rows):
    df = rows([(1.0, "a"), (float("nan"), "b"), (None, "c"), (2.0, None)], "x double, y string")
    assert [r.y for r in R.require_not_null(df, ["x", "y"]).collect()] == ["a", "b"]


def test_positive(rows):
    df = rows([(1, 1), (0, 1), (-1, 1), (None, 1), (2, 0)], "x int, y int")
    assert found(R.require_positive(df, ["x", "y"])) == [(1, 1)]


def test_text_filter(rows):
    df = rows([("a",), ("",), (None,), (" ",)], "x string")
    assert found(R.require_text(df, "x")) == [(" ",), ("a",)]


def test_keep_known_does_not_multiply(rows):
    df = rows([(1, "a"), (2, "b"), (3, None)], "id int, c string")
    ref = rows([("a",), ("a",), (None,)], "c string")
    assert found(R.keep_known(df, ref, ["c"]), "id") == [(1,)]


def test_cascade_prune(rows):
    items = rows([("o1", "p1"), ("o1", "p2"), ("o2", "p3"), ("o3", "p4")], "o string, product_id string")
    products = rows(
        [("p1", "a"), ("p2", "b"), ("p3", ""), ("p4", None)],
        "product_id string, product_category_name string",
    )
    categories = rows([("a",), ("",)], "product_category_name string")
    assert found(R.cascade_prune(items, products, categories), "o", "product_id") == [("o1", "p1")]


def test_dedup_first_null_keys_and_partitions(rows):
    df = rows(
        [("k", 2, "late"), ("k", 1, "early"), (None, 5, "n2"), (None, 4, "n1")],
        "k string, pos int, v string",
    )
    for n in (1, 7):
        kept = R.dedup_first(df.repartition(n), ["k"], ["pos"])
        assert kept.columns == ["k", "pos", "v"]
        assert found(kept) == [("k", 1, "early"), (None, 4, "n1")]


def test_dedup_first_hot_key_shrinks_before_the_shuffle(spark):
    df = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("pos")
    )
    kept = R.dedup_first(df, ["k"], ["pos"])
    assert kept.count() == 20001
    assert kept.where("k = 0").first().pos == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange")
    assert "partial_min_by" in plan[exchange:]


def test_keep_latest_breaks_ties_by_value(rows):
    df = rows([(1, 5, "a"), (1, 5, "b"), (1, 4, "z"), (2, None, "n")], "k int, s int, v string")
    for n in (1, 5):
        assert found(R.keep_latest(df.repartition(n), ["k"], ["s"])) == [(1, 5, "b"), (2, None, "n")]


def test_smallest_per_key_of_keys_only(rows):
    df = rows([(1,), (1,), (2,)], "k int")
    assert found(R.smallest_per_key(df, ["k"])) == [(1,), (2,)]


def test_key_violations(rows):
    df = rows([(1, "a"), (1, "a"), (1, "b"), (None, "a"), (None, "a")], "k int, v string")
    assert found(Q.key_violations(df, ["k", "v"])) == [(1, "a", 2), (None, "a", 2)]


def test_fk_orphans_ignores_null(rows):
    child = rows([(1, "a"), (2, "x"), (3, None)], "id int, ref string")
    parent = rows([("a",), (None,)], "key string")
    assert found(Q.fk_orphans(child, parent, {"ref": "key"})) == [(2, "x")]
    same = parent.withColumnRenamed("key", "ref")
    assert found(Q.fk_orphans(child, same, ["ref"])) == [(2, "x")]


def test_null_violations(rows):
    df = rows([(1, None), (2, None), (None, "x")], "a int, b string")
    assert found(Q.null_violations(df, ["a", "b"])) == [("a", 1), ("b", 2)]


def test_length_units(rows):
    df = rows([(1, "é" * 255), (2, "x" * 256), (3, None)], "id int, t string")
    assert found(Q.length_violations(df, {"t": 255}, ["id"])) == [(2, "t", 256, 255)]
    by_bytes = Q.length_violations(df, {"t": 255}, ["id"], unit="bytes")
    assert found(by_bytes) == [(1, "t", 510, 255), (2, "t", 256, 255)]
    with pytest.raises(ValueError):
        Q.length_violations(df, {"t": 255}, ["id"], unit="words")


def test_check_table(rows):
    spec = TableSpec("t", dict(id=INT, name=TEXT, x=DOUBLE), key=("id",), limits=dict(name=2))
    df = rows([(1, "abc", 1.0), (1, None, None)], "id int, name string, x double")
    report = {(r.check_name, r.subject): r.n_violations for r in Q.check_table(df, spec, {}).collect()}
    assert report == {
        ("key", "id"): 1,
        ("not_null", "id"): 0,
        ("not_null", "name"): 1,
        ("not_null", "x"): 1,
        ("length", "name"): 1,
    }


def test_specs_are_consistent():
    for spec in (*SOURCE_TABLES.values(), *STAR_TABLES.values()):
        named = {*spec.key, *spec.nullable, *spec.lenient, *spec.free_text, *spec.limits}
        named |= {c for r in spec.references for c in r.columns}
        assert named <= set(spec.columns), spec.name
        for ref in spec.references:
            parent = {**SOURCE_TABLES, **STAR_TABLES}[ref.parent]
            assert set(ref.parent_columns) <= set(parent.columns)
    assert len(SOURCE_TABLES) == 9 and len(STAR_TABLES) == 8
    assert ORDER_ITEMS.required == ORDER_ITEMS.columns
