"""Staging tables with one row per key: parquet, partitioned by a hash of the key.

    <path>/_buckets=64/_bucket=17/part-....parquet

A write reduces its rows to one per key, reads the buckets they fall into, keeps the last row of
every key and writes these buckets anew by dynamic partition overwrite; the others stay as they are.
So its cost follows the touched buckets, a join on the key meets rows of one bucket only, and no
bucket needs to be compacted. The number of buckets is part of the path and holds for every writer.

The last row is that with the largest `seq`, then with the latest arrival. A load arrives when it is
written; a stream's rows carry the time that Spark logs for their micro-batch, which is the same
when the micro-batch is tried again, so a repeated write changes nothing. Deleted keys stay as
tombstones, so that an older change which comes later does not bring them back.

Keys must hold a value: a NULL in a key column fails the write. One writer at a time; readers that
are under way while their buckets are replaced must start again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.operators.rows import keep_latest
from martloom.shared import written
from martloom.specs import TableSpec

DELETED = "_deleted"
ARRIVAL = "_arrival"
BUCKETS = "_buckets"
BUCKET = "_bucket"
DEFAULT_BUCKETS = 16


def arrived(df: DataFrame) -> DataFrame:
    """`df` with the time of its arrival: of a stream's rows that of their micro-batch."""
    return df.withColumn(ARRIVAL, F.unix_micros(F.current_timestamp()))


@dataclass(frozen=True)
class StagingTable:
    """`seq` orders the writes of one key; rows with equal `seq` follow their arrival.

    Rows of one write with equal `seq` are told apart by their values, so that a repeated write
    stores the same row again; with `unique` they fail the write instead.
    """

    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    seq: tuple[str, ...] = ()
    buckets: int | None = None
    unique: bool = False

    @classmethod
    def of(
        cls,
        path: str,
        spec: TableSpec,
        seq: Sequence[str] = (),
        buckets: int | None = None,
        keys: Sequence[str] | None = None,
        unique: bool = False,
    ) -> StagingTable:
        """A table with the columns and the key of `spec`, or other `keys`."""
        return cls(path, spec.schema, tuple(keys or spec.key), tuple(seq), buckets, unique)

    @classmethod
    def of_changes(
        cls, path: str, spec: TableSpec, seq: T.StructField, buckets: int | None = None
    ) -> StagingTable:
        """A table that keeps the sequence of the last change beside the columns of `spec`."""
        schema = T.StructType([*spec.schema.fields, seq])
        return cls(path, schema, tuple(spec.key), (seq.name,), buckets)

    def create_if_absent(self, spark: SparkSession) -> None:
        if self._stored_rows(spark) is None:
            empty = spark.createDataFrame([], self._stored)
            empty.write.mode("append").partitionBy(BUCKETS, BUCKET).parquet(self.path)

    def upsert(self, df: DataFrame) -> None:
        """Store the last row per key of `df`; a row with `_deleted` set is a tombstone."""
        spark = df.sparkSession
        stored = self._stored_rows(spark)
        count = self._count(stored)
        if DELETED not in df.columns:
            df = df.withColumn(DELETED, F.lit(False))
        if ARRIVAL not in df.columns:
            df = arrived(df)
        wanted = self._stored.fields[:-2]
        rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted])
        latest = keep_latest(self._checked(rows), self.keys, self._order)
        # fixed once: it is read for the buckets it touches and for its rows
        batch = written(
            latest.withColumns(
                {BUCKETS: F.lit(count), BUCKET: F.pmod(F.xxhash64(*self.keys), F.lit(count)).cast("int")}
            ),
            "batch",
        )
        touched = [r[0] for r in batch.select(BUCKET).distinct().collect()]  # at most `count`
        if not touched:
            return self.create_if_absent(spark)
        if stored is not None:
            same = stored.where(F.col(BUCKET).isin(touched))
            batch = same.select(*batch.columns).unionByName(batch)
        # both sides have a key once, so a bucket is as large as its keys are many
        self._replace(keep_latest(batch.repartition(BUCKET), [*self.keys, BUCKETS, BUCKET], self._order))

    def current(self, spark: SparkSession) -> DataFrame:
        """The live rows: the last write of every key, without the deleted ones."""
        stored = self._stored_rows(spark)
        if stored is None:
            return spark.createDataFrame([], self.schema)
        return stored.where(~F.col(DELETED)).select(*self.schema.names)

    def forget_deleted(self, spark: SparkSession) -> None:
        """Rewrite the buckets that hold tombstones without them, once no older change of their keys
        can still arrive."""
        stored = self._stored_rows(spark)
        if stored is None:
            return
        touched = [r[0] for r in stored.where(DELETED).select(BUCKET).distinct().collect()]
        # a bucket that holds nothing else keeps its tombstones: an overwrite of no rows does nothing
        if touched:
            self._replace(stored.where(F.col(BUCKET).isin(touched) & ~F.col(DELETED)).repartition(BUCKET))

    def _replace(self, rows: DataFrame) -> None:
        """Overwrite the buckets that `rows` have rows in."""
        (
            rows.select(*self._stored.names)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(BUCKETS, BUCKET).parquet(self.path)
        )

    def _count(self, stored: DataFrame | None) -> int:
        """The number of buckets that the table was made with, else that of this object."""
        first = stored.select(BUCKETS).first() if stored is not None else None
        return first[0] if first else self.buckets or DEFAULT_BUCKETS

    def _checked(self, rows: DataFrame) -> DataFrame:
        """Fails for a NULL in the key and, with `unique`, for a key whose last row is not clear."""
        missing = F.raise_error(F.lit(f"NULL in the key of {self.path}")).cast("boolean")
        filled = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.keys])
        rows = rows.where(F.when(~filled, missing).otherwise(True))
        if not self.unique:
            return rows
        ordered = [*self.keys, *[s for s in self._order if s not in self.keys]]
        rest = F.struct(*[c for c in rows.columns if c not in ordered])
        counted = rows.groupBy(*ordered).agg(F.count("*").alias("_n"), F.min(rest).alias("_r"))
        shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in self.keys])
        twice = F.raise_error(F.concat(F.lit("key given twice in one batch: "), shown))
        single = counted.where(F.when(F.col("_n") > 1, twice.cast("boolean")).otherwise(True))
        return single.select(
            *[c if c in ordered else F.col("_r").getField(c).alias(c) for c in rows.columns]
        )

    def _stored_rows(self, spark: SparkSession) -> DataFrame | None:
        try:
            return spark.read.schema(self._stored).parquet(self.path)
        except AnalysisException as failure:
            if failure.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    @property
    def _order(self) -> tuple[str, ...]:
        return (*self.seq, ARRIVAL)

    @property
    def _stored(self) -> T.StructType:
        return T.StructType(
            [
                *self.schema.fields,
                T.StructField(DELETED, T.BooleanType()),
                T.StructField(ARRIVAL, T.LongType()),
                T.StructField(BUCKETS, T.IntegerType()),
                T.StructField(BUCKET, T.IntegerType()),
            ]
        )
