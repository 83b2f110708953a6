"""Merges against plain dictionaries on random batches."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martloom.operators import merge as M
from martloom.operators.rows import keep_latest

KEYS = st.sampled_from("abcdef")
VALUES = st.one_of(st.none(), st.integers(0, 9))
ROWS = st.lists(st.tuples(KEYS, VALUES), max_size=12)
UNIQUE = st.dictionaries(KEYS, VALUES, max_size=6)
CHANGES = st.lists(
    st.tuples(st.sampled_from(["create", "update", "delete"]), KEYS, VALUES), max_size=15
)
few = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
KV = "k string, v int"


def as_dict(df):
    rows = df.collect()
    found = {r.k: r.v for r in rows}
    assert len(found) == len(rows)
    return found


def null_first(v):
    return (v is not None, v or 0)


@few
@given(target=UNIQUE, batch=ROWS)
def test_insert_if_absent(spark, target, batch):
    expected = {}
    for k, v in batch:
        if k not in expected or null_first(v) < null_first(expected[k]):
            expected[k] = v
    expected |= target
    frames = [spark.createDataFrame(list(rows), KV) for rows in (target.items(), batch)]
    assert as_dict(M.insert_if_absent(*frames, ["k"])) == expected


@few
@given(target=UNIQUE, batch=UNIQUE)
def test_upsert(spark, target, batch):
    frames = [spark.createDataFrame(list(rows.items()), KV) for rows in (target, batch)]
    once = M.upsert(*frames, ["k"], ["v"])
    assert as_dict(once) == target | batch
    assert as_dict(M.upsert(once, frames[1], ["k"], ["v"])) == target | batch
    assert as_dict(M.update_matched(*frames, ["k"], ["v"])) == {
        k: batch.get(k, v) for k, v in target.items()
    }


@few
@given(target=UNIQUE, changes=CHANGES, parts=st.integers(1, 5))
def test_apply_changes(spark, target, changes, parts):
    expected = dict(target)
    for op, k, v in changes:
        if op == "delete":
            expected.pop(k, None)
        else:
            expected[k] = v
    rows = [(op, seq, k, v) for seq, (op, k, v) in enumerate(changes)]
    frame = spark.createDataFrame(rows, "op string, seq long, k string, v int").repartition(parts)
    before = spark.createDataFrame(list(target.items()), KV)
    assert as_dict(M.apply_changes(before, frame, ["k"], ["seq"], "op")) == expected


@few
@given(rows=st.lists(st.tuples(KEYS, VALUES), max_size=15), parts=st.integers(1, 5))
def test_keep_latest(spark, rows, parts):
    frame = spark.createDataFrame(
        [(k, v, seq) for seq, (k, v) in enumerate(rows)], KV + ", seq long"
    ).repartition(parts)
    assert as_dict(keep_latest(frame, ["k"], ["seq"])) == dict(rows)
