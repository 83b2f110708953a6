"""Continuous writes into staging tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martloom.sinks.loads import staged
from martloom.sinks.staging import DELETED, StagingTable, arrived
from martloom.sources.changes import DELETE, OP, SEQ, SEQ_FIELD, read_changes
from martloom.specs import SOURCE_TABLES, TableSpec

# Fixed value: flush interval of the buffered sink.
FLUSH_INTERVAL = "5 seconds"


def stream_changes(
    spark: SparkSession,
    spec: TableSpec,
    path: str,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    return read_changes(
        spark, path, spec, max_files_per_trigger=max_files_per_trigger,
        max_bytes_per_trigger=max_bytes_per_trigger,
    )


def stream_clean(stream: DataFrame, spec: TableSpec) -> DataFrame:
    """Stateless cleaning, as `staged` does it for a batch."""
    return staged(stream, spec)


def stream_upsert(
    stream: DataFrame,
    target: StagingTable,
    checkpoint: str,
    available_now: bool = False,
    interval: str = FLUSH_INTERVAL,
    output_mode: str = "append",
) -> StreamingQuery:
    """Keep the last row per key in `target`.

    Every micro-batch is reduced to one row per key and merged into the buckets it touches. Its rows
    carry the time that the checkpoint holds for it, so a micro-batch that runs again after a failure
    takes the place of its first try, also where later writes have come since.
    """

    target.create_if_absent(stream.sparkSession)

    def flush(rows: DataFrame, number: int) -> None:
        target.upsert(rows)

    writer = (
        arrived(stream).writeStream.foreachBatch(flush).outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def stream_apply_changes(
    changes: DataFrame,
    target: StagingTable,
    checkpoint: str,
    op: str = OP,
    seq: str = SEQ,
    delete: str = DELETE,
    available_now: bool = False,
    interval: str = FLUSH_INTERVAL,
) -> StreamingQuery:
    """Fold creates, updates and deletes into `target` by sequence.

    A delete leaves a tombstone with its sequence, so an older change that arrives later cannot
    bring the row back. `seq` must be among the columns of `target` and order its writes.
    """
    if seq not in target.seq:
        raise ValueError(f"the target does not order its writes by {seq!r}")
    marked = changes.withColumn(DELETED, F.col(op) == delete)
    return stream_upsert(marked, target, checkpoint, available_now, interval)


def stream_published(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    names: Sequence[str] | None = None,
    available_now: bool = False,
    interval: str = FLUSH_INTERVAL,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    specs: Mapping[str, TableSpec] = SOURCE_TABLES,
) -> dict[str, StreamingQuery]:
    """One change stream per published table, from `<source>/<name>` into `<target>/<name>`.

    Reviews are cleaned and cut on the way, as in the batch copies.
    """
    started = {}
    for name in names or list(specs):
        spec = specs[name]
        changes = stream_changes(
            spark, spec, f"{source}/{name}", max_files_per_trigger, max_bytes_per_trigger
        )
        clean = staged(changes, spec, keep=(OP, SEQ))
        started[name] = stream_apply_changes(
            clean,
            StagingTable.of_changes(f"{target}/{name}", spec, SEQ_FIELD),
            f"{checkpoint}/{name}",
            available_now=available_now,
            interval=interval,
        )
    return started
