"""Streams that remember: newest change per key, totals of windows in event time."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from martloom.sinks.staging import DELETED, StagingTable
from martloom.sources.changes import DELETE, OP, SEQ
from martloom.streaming.upsert import FLUSH_INTERVAL, stream_upsert

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}
# With timers a stream is never done: it would go on with empty micro-batches to look at the clock.
ENDS = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}
# How long a deleted key is remembered, in which an older change of it may still come.
TOMBSTONE_MS = 7 * 24 * 3600 * 1000
# The time that a deleted key is remembered ends at one of so many steps.
TOMBSTONE_STEPS = 16
# Keys are dealt over so many groups, each of which a micro-batch hands over in one call.
STATE_GROUPS = 1024


@contextmanager
def started_with(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """The settings hold for the streams that are started in the block, for as long as they run."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


class NewestChange(StatefulProcessor):
    """Lets the newest change of a key through if no newer one came before. The state of a key is
    its last sequence; that of a deleted key goes after a while.

    A call is for a group of keys, and their states are one value, an Arrow table: what a call and a
    look into the store cost is paid by group, not by key. A micro-batch rewrites the groups it
    touches."""

    def __init__(
        self,
        names: Sequence[str],
        keys: Sequence[str],
        op: str,
        seq: str,
        delete: str,
        tombstone_ms: int,
        groups: int,
    ):
        self.key_at = [names.index(k) for k in keys]
        self.op_at, self.seq_at = names.index(op), names.index(seq)
        self.delete, self.tombstone_ms, self.groups = delete, tombstone_ms, groups
        self.step_ms = max(1, tombstone_ms // TOMBSTONE_STEPS)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "groups int, keys binary")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        newest = {}
        for row in rows:  # a hot key has many, of which one is kept
            values = tuple(row)
            changed, seq = tuple([values[i] for i in self.key_at]), values[self.seq_at]
            if changed not in newest or seq > newest[changed][0]:
                newest[changed] = seq, row
        known, let_through, any_deleted = self._known(), [], False
        # remembered at least so long; a step has one time for all its keys
        until = timerValues.getCurrentProcessingTimeInMs() + self.tombstone_ms
        until = -(-until // self.step_ms) * self.step_ms
        for changed, (seq, row) in newest.items():
            if changed in known and seq <= known[changed][0]:
                continue
            deleted = row[self.op_at] == self.delete
            known[changed] = seq, until if deleted else None
            any_deleted |= deleted
            let_through.append(row)
        if let_through:
            self._keep(known)
        if any_deleted:
            self.handle.registerTimer(until)
        return iter(let_through)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        known = self._known()
        left = {k: v for k, v in known.items() if v[1] is None or v[1] > now}
        if not left:
            self.last.clear()
        elif len(left) < len(known):
            self._keep(left)
        return iter(())

    def close(self) -> None:
        pass

    def _known(self) -> dict[tuple, tuple[int, int | None]]:
        """Sequence of each key of the group, and the time at which a deleted one is forgotten."""
        stored = self.last.get()
        if stored is None:
            return {}
        groups, packed = stored
        if groups != self.groups:
            raise ValueError(f"the checkpoint was made with {groups} groups, not {self.groups}")
        with pa.ipc.open_stream(bytes(packed)) as reader:
            *keys, seqs, untils = [c.to_pylist() for c in reader.read_all().columns]
        return dict(zip(zip(*keys), zip(seqs, untils)))

    def _keep(self, known: Mapping[tuple, tuple[int, int | None]]) -> None:
        columns = [pa.array(c) for c in zip(*known)]
        columns += [pa.array(c, pa.int64()) for c in zip(*known.values())]
        table = pa.table(columns, names=[str(i) for i in range(len(columns))])
        packed = pa.BufferOutputStream()
        with pa.ipc.new_stream(packed, table.schema) as writer:
            writer.write_table(table)
        self.last.update((self.groups, packed.getvalue().to_pybytes()))


def newest_changes(
    changes: DataFrame,
    keys: Sequence[str],
    op: str = OP,
    seq: str = SEQ,
    delete: str = DELETE,
    tombstone_ms: int = TOMBSTONE_MS,
    groups: int = STATE_GROUPS,
) -> DataFrame:
    """The changes of a stream that are newer than all before them of their key: at most one per key
    and micro-batch, whatever order they come in. A NULL key or sequence is left out.

    Each task keeps its keys' last sequences in a RocksDB store, which the stream must be started
    with (see `STATE_STORE`) and which Spark saves beside the checkpoint. The keys are dealt over
    `groups`, whose number a checkpoint is bound to: small micro-batches over very many keys want more.
    """
    rows = changes
    for column in (*keys, seq):
        rows = rows.where(F.col(column).isNotNull())
    group = F.pmod(F.xxhash64(*keys), F.lit(groups)).cast("int")
    return rows.withColumn("_group", group).groupBy("_group").transformWithState(
        statefulProcessor=NewestChange(
            changes.columns, keys, op, seq, delete, tombstone_ms, groups
        ),
        outputStructType=changes.schema,
        outputMode="Update",
        timeMode="ProcessingTime",
    )


def stream_apply_newest(
    changes: DataFrame,
    target: StagingTable,
    checkpoint: str,
    op: str = OP,
    seq: str = SEQ,
    delete: str = DELETE,
    available_now: bool = False,
    interval: str = FLUSH_INTERVAL,
    tombstone_ms: int = TOMBSTONE_MS,
    groups: int = STATE_GROUPS,
) -> StreamingQuery:
    """Fold creates, updates and deletes into `target`. The stream's state keeps late changes back,
    so the target needs no sequence column: rows come to it in their order."""
    newest = newest_changes(changes, target.keys, op, seq, delete, tombstone_ms, groups)
    marked = newest.withColumn(DELETED, F.col(op) == delete)
    with started_with(changes.sparkSession, STATE_STORE | (ENDS if available_now else {})):
        return stream_upsert(marked, target, checkpoint, available_now, interval, "update")


def window_totals(
    events: DataFrame,
    time: str,
    window: str,
    delay: str,
    keys: Sequence[str],
    totals: Sequence[Column],
) -> DataFrame:
    """Totals of each window of event time and key: `window_start`, `window_end`, keys, totals.

    The watermark lies `delay` behind the latest time seen in the micro-batches before. A row whose
    window ended at or before it is late and dropped; a window is given out once the watermark has
    passed its end, and its state is then forgotten. Rows with a NULL time are dropped. Times without
    zone are taken as they are written.
    """
    plain = events.schema[time].dataType == T.TimestampNTZType()
    counted = (
        events.withColumn("_time", _as_utc(F.col(time)) if plain else F.col(time))
        .withWatermark("_time", delay)
        .groupBy(F.window("_time", window).alias("_window"), *keys)
        .agg(*totals)
    )
    rest = [c for c in counted.columns if c not in ("_window", *keys)]
    edges = [F.col(f"_window.{edge}") for edge in ("start", "end")]
    if plain:
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        edges = [epoch + F.make_dt_interval(secs=F.unix_seconds(e)) for e in edges]
    start, end = edges
    return counted.select(start.alias("window_start"), end.alias("window_end"), *keys, *rest)


def _as_utc(time: Column) -> Column:
    """A timestamp without zone as the same one in UTC, whatever the session's zone."""
    days = F.date_diff(time.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    seconds = days * 86_400 + F.hour(time) * 3600 + F.minute(time) * 60
    micros = F.extract(F.lit("SECOND"), time) * 1_000_000
    return F.timestamp_micros(seconds * 1_000_000 + micros.cast("long"))
