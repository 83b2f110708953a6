import random
import shutil

import pytest
from pyspark.sql import functions as F

from martloom.operators.merge import apply_changes
from martloom.operators.rows import keep_latest
from martloom.plans.ingest import ingest
from martloom.sinks.staging import StagingTable
from martloom.sources.changes import SEQ_FIELD, change_schema
from martloom.specs import INT, LONG, SOURCE_TABLES, TEXT, TableSpec
from martloom.streaming.upsert import (
    stream_apply_changes,
    stream_changes,
    stream_clean,
    stream_published,
    stream_upsert,
)

SPEC = TableSpec("t", dict(k=TEXT, v=INT), key=("k",))
WITH_SEQ = TableSpec("t", dict(k=TEXT, seq=LONG, v=INT), key=("k",))
from test_sources_ingest import csv_tables


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def changes(seed):
    rng = random.Random(seed)
    ops = ["create", "update", "update", "delete"]
    return [
        (rng.choice(ops), seq, f"k{rng.randrange(12)}", rng.randrange(100)) for seq in range(200)
    ]


def key_only_deletes(rows):
    return [(op, seq, k, None if op == "delete" else v) for op, seq, k, v in rows]


@pytest.mark.parametrize("seed", [1, 2])
def test_changes_in_any_order_equal_the_batch(spark, rows, tmp_path, seed):
    data = key_only_deletes(changes(seed))
    shuffled = data[:]
    random.Random(seed).shuffle(shuffled)
    source = str(tmp_path / "changes")
    schema = change_schema(SPEC)
    for i in range(0, len(shuffled), 50):
        part = spark.createDataFrame(shuffled[i : i + 50], schema)
        part.coalesce(1).write.mode("append").parquet(source)
    target = StagingTable.of(str(tmp_path / "t"), WITH_SEQ, seq=("seq",))
    stream = stream_changes(spark, SPEC, source, max_files_per_trigger=1)
    query = stream_apply_changes(stream, target, str(tmp_path / "cp"), available_now=True)
    query.awaitTermination()
    empty = rows([], "k string, v int")
    expected = apply_changes(empty, spark.createDataFrame(data, schema), ["k"], ["seq"], "op")
    assert found(target.current(spark).select("k", "v")) == found(expected)
    target.forget_deleted(spark)
    assert found(target.current(spark).select("k", "v")) == found(expected)


def test_upsert_resumes_and_replays(spark, rows, tmp_path):
    source, schema = str(tmp_path / "in"), "k string, seq long, v int"
    target = StagingTable.of(str(tmp_path / "t"), WITH_SEQ, seq=("seq",))

    def run(checkpoint):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        stream_upsert(stream, target, checkpoint, available_now=True).awaitTermination()

    parts = [[("a", 1, 1), ("b", 2, 2)], [("a", 3, 3)], [("b", 1, 9), ("c", 4, 4)]]
    everything = []
    for part in parts:
        everything += part
        rows(part, schema).coalesce(1).write.mode("append").parquet(source)
        run(str(tmp_path / "cp"))
        expected = keep_latest(rows(everything, schema), ["k"], ["seq"])
        assert found(target.current(spark)) == found(expected)
    # a second stream over the same rows changes nothing
    run(str(tmp_path / "cp2"))
    assert found(target.current(spark)) == [("a", 3, 3), ("b", 2, 2), ("c", 4, 4)]


def test_micro_batch_that_failed_after_its_write_is_written_again(spark, rows, tmp_path):
    class Failing(StagingTable):
        def upsert(self, df):
            super().upsert(df)
            raise RuntimeError("lost after the write")

    path, source = str(tmp_path / "t"), str(tmp_path / "in")
    rows([("a", 1), ("b", 1)], "k string, v int").write.parquet(source)

    def run(target):
        stream = spark.readStream.schema("k string, v int").parquet(source)
        query = stream_upsert(stream, target, str(tmp_path / "cp"), available_now=True)
        query.awaitTermination()

    with pytest.raises(Exception, match="lost after the write"):
        run(Failing.of(path, SPEC))
    target = StagingTable.of(path, SPEC)
    target.upsert(rows([("a", 2)], "k string, v int"))
    run(target)
    assert found(target.current(spark)) == [("a", 2), ("b", 1)]


def test_a_new_checkpoint_at_the_old_place_is_another_stream(spark, rows, tmp_path):
    target = StagingTable.of(str(tmp_path / "t"), SPEC)
    for turn, data in enumerate(([("a", 1)], [("a", 2), ("b", 2)])):
        source = str(tmp_path / f"in{turn}")
        rows(data, "k string, v int").coalesce(1).write.parquet(source)
        stream = spark.readStream.schema("k string, v int").parquet(source)
        stream_upsert(stream, target, str(tmp_path / "cp"), available_now=True).awaitTermination()
        shutil.rmtree(tmp_path / "cp")
    assert found(target.current(spark)) == [("a", 2), ("b", 2)]


def test_files_stay_few_however_many_micro_batches(spark, rows, tmp_path):
    target = StagingTable.of(str(tmp_path / "t"), SPEC, buckets=4)
    source = str(tmp_path / "in")
    rows([(f"k{i % 7}", i) for i in range(30)], "k string, v int").repartition(30).write.option(
        "maxRecordsPerFile", 1
    ).parquet(source)
    stream = spark.readStream.schema("k string, v int").option("maxFilesPerTrigger", 2).parquet(source)
    query = stream_upsert(stream, target, str(tmp_path / "cp"), available_now=True)
    query.awaitTermination()
    assert query.lastProgress["batchId"] >= 12
    assert len(list((tmp_path / "t").rglob("*.parquet"))) <= 4
    assert len(found(target.current(spark))) == 7


def test_stream_does_not_replace_a_batch_load(spark, rows, tmp_path):
    target = StagingTable.of(str(tmp_path / "t"), SPEC)
    target.create_if_absent(spark)
    target.upsert(rows([("x", 1), ("a", 0)], "k string, v int"))
    source = str(tmp_path / "in")
    rows([("a", 1)], "k string, v int").write.parquet(source)
    stream = spark.readStream.schema("k string, v int").parquet(source)
    stream_upsert(stream, target, str(tmp_path / "cp"), available_now=True).awaitTermination()
    assert found(target.current(spark)) == [("a", 1), ("x", 1)]


def test_all_published_tables(spark, tmp_path):
    clean = ingest(spark, csv_tables(tmp_path))
    for name, df in clean.items():
        head = df.select(F.lit("create").alias("op"), F.lit(1).cast("long").alias("seq"), "*")
        head.write.parquet(str(tmp_path / "changes" / name))
    key = SOURCE_TABLES["order_reviews"].key[0]
    gone = clean["order_reviews"].where(f"{key} = 'r2'").select(
        F.lit("delete").alias("op"), F.lit(2).cast("long").alias("seq"), key
    )
    gone.write.mode("append").parquet(str(tmp_path / "changes" / "order_reviews"))
    paths = [str(tmp_path / d) for d in ("changes", "staging", "checkpoints")]
    for query in stream_published(spark, *paths, available_now=True).values():
        query.awaitTermination()
    for name, df in clean.items():
        table = StagingTable.of_changes(str(tmp_path / "staging" / name), SOURCE_TABLES[name], SEQ_FIELD)
        stored = table.current(spark).drop("seq")
        assert stored.columns == df.columns
        if name == "order_reviews":
            row = stored.collect()
            assert [r.review_id for r in row] == ["r1"]
            assert row[0].review_comment_message == "first line"
        else:
            assert found(stored) == found(df), name


def test_change_target_must_order_by_sequence(spark, tmp_path):
    target = StagingTable.of(str(tmp_path / "t"), SPEC)
    with pytest.raises(ValueError, match="seq"):
        stream_apply_changes(spark.readStream.format("rate").load(), target, str(tmp_path / "cp"))


def test_every_published_table_has_a_change_schema():
    for spec in SOURCE_TABLES.values():
        names = change_schema(spec).names
        assert names[:2] == ["op", "seq"] and names[2:] == spec.columns


def test_clean_is_stateless(spark, tmp_path):
    spec = TableSpec("r", dict(id=TEXT, t=TEXT), key=("id",), free_text=("t",))
    source = str(tmp_path / "in")
    spark.createDataFrame([("1", "a\tb\r\nc" + "x" * 300)], "id string, t string").write.parquet(source)
    stream = stream_clean(spark.readStream.schema(spec.schema).parquet(source), spec)
    assert stream.isStreaming
    out = str(tmp_path / "out")
    (
        stream.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        .awaitTermination()
    )
    assert spark.read.parquet(out).select(F.length("t"), F.left("t", F.lit(6))).first() == (255, "a b  c")
