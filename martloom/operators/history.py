"""Joins in time: the last row before a moment, and the row that was valid at one.

Both cut time into buckets of fixed length. What lies in one bucket of a key is sorted there; what
has to be carried from bucket to bucket is one row per key and bucket, found by partial aggregation.
So the history of a hot key is sorted in as many tasks as it has buckets, never in one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY = 86_400


def _bucket(time: Column, kind: T.DataType, seconds: int) -> Column:
    """Number of the time's bucket; it never falls as time goes on, in no time zone."""
    if kind == T.TimestampType():
        whole = F.unix_seconds(time)
    else:  # dates and timestamps without zone, read as they are written
        days = F.date_diff(time.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
        at = time.cast("timestamp_ntz")
        whole = days * DAY + F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)
    return F.floor(whole / seconds).cast("long")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    bucket_seconds: int = DAY,
) -> DataFrame:
    """Every row of `left` with the last row of `right` of the same `on` columns whose time is not
    after its own; NULLs where there is none, where the key or time is NULL.

    Columns of `right` other than `on` are added and must have other names than those of `left`. Of
    rows of `right` with one key and time the largest counts.
    """
    values = [c for c in right.columns if c not in on]
    clash = set(values) & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides: {', '.join(sorted(clash))}")
    known = right.where(F.col(right_time).isNotNull())
    found = F.struct(F.col(right_time).alias("_time"), *values)
    kind = known.select(found.alias("f")).schema["f"].dataType
    events = known.select(
        *on, F.col(right_time).alias("_at"), F.lit(0).alias("_side"), found.alias("_found"),
        F.lit(None).cast(left.select(F.struct("*").alias("r")).schema["r"].dataType).alias("_row"),
    )
    asked = left.select(
        *on, F.col(left_time).alias("_at"), F.lit(1).alias("_side"),
        F.lit(None).cast(kind).alias("_found"), F.struct("*").alias("_row"),
    )
    both = events.unionByName(asked)
    at = both.schema["_at"].dataType
    both = both.withColumn("_bucket", _bucket(F.col("_at"), at, bucket_seconds))
    # the last of each bucket, carried on to the buckets after it
    lasts = both.groupBy(*on, "_bucket").agg(F.max("_found").alias("_last"))
    earlier = Window.partitionBy(*on).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select(
        *[F.col(c).alias(f"_on_{c}") for c in on], F.col("_bucket").alias("_of"),
        F.max("_last").over(earlier).alias("_carried"),
    )
    inside = Window.partitionBy(*on, "_bucket").orderBy("_at", "_side").rowsBetween(
        Window.unboundedPreceding, 0
    )
    seen = both.withColumn("_found", F.max("_found").over(inside)).where("_side = 1")
    same = F.col("_bucket").eqNullSafe(F.col("_of"))
    for c in on:
        same &= F.col(c).eqNullSafe(F.col(f"_on_{c}"))
    last = F.coalesce("_found", "_carried")
    usable = F.col("_at").isNotNull()
    for c in on:
        usable &= F.col(c).isNotNull()
    last = F.when(usable, last)
    return seen.join(carried, same, "left").select(
        *[F.col("_row").getField(c).alias(c) for c in left.columns],
        *[last.getField(c).alias(c) for c in values],
    )


def validity(
    changes: DataFrame,
    keys: Sequence[str],
    time: str,
    seq: str,
    deleted: Column | None = None,
    bucket_seconds: int = DAY,
) -> DataFrame:
    """The changes as a history: every row with `valid_from`, its time, and `valid_to`, the time of
    the key's next change (NULL for the last). Rows that `deleted` marks end the one before them and
    are left out, as are rows that the next one replaces at the same time. `seq` orders changes of
    one time; NULL keys and times are left out.
    """
    rows = changes.where(F.col(time).isNotNull())
    for key in keys:
        rows = rows.where(F.col(key).isNotNull())
    rows = rows.withColumn("_gone", F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False))
    kind = changes.schema[time].dataType
    rows = rows.withColumn("_bucket", _bucket(F.col(time), kind, bucket_seconds))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(time, seq)
    firsts = rows.groupBy(*keys, "_bucket").agg(F.min(time).alias("_first"))
    later = Window.partitionBy(*keys).orderBy("_bucket")
    following = firsts.select(*keys, "_bucket", F.lead("_first").over(later).alias("_next"))
    ended = rows.withColumn("_within", F.lead(time).over(inside)).join(following, [*keys, "_bucket"])
    return ended.select(
        *changes.columns, F.col(time).alias("valid_from"),
        F.coalesce("_within", "_next").alias("valid_to"), "_gone",
    ).where("NOT _gone AND (valid_to IS NULL OR valid_to > valid_from)").drop("_gone")


def valid_at(
    facts: DataFrame,
    history: DataFrame,
    on: Sequence[str],
    time: str,
    until: Column,
    bucket_seconds: int = 30 * DAY,
) -> DataFrame:
    """Every row of `facts` with the columns of the row of `history` that was valid at its `time`
    (from `valid_from`, before `valid_to`); NULLs where there is none.

    A validity is listed once per bucket of time that it touches, an open one up to `until`, at or
    after the last time of `facts`. Key and bucket are then an equijoin, so no row meets more of the
    history than one bucket of its key.
    """
    values = [c for c in history.columns if c not in on]
    kind = history.schema["valid_from"].dataType
    first = _bucket(F.col("valid_from"), kind, bucket_seconds)
    last = _bucket(F.coalesce("valid_to", until.cast(kind)), kind, bucket_seconds)
    buckets = F.sequence(first, F.greatest(first, last))
    listed = history.select(
        *[F.col(c).alias(f"_on_{c}") for c in on], *values, F.explode(buckets).alias("_bucket")
    )
    same = _bucket(F.col(time), facts.schema[time].dataType, bucket_seconds) == F.col("_bucket")
    for c in on:
        same &= F.col(c) == F.col(f"_on_{c}")
    inside = (F.col(time) >= F.col("valid_from")) & (
        F.col("valid_to").isNull() | (F.col(time) < F.col("valid_to"))
    )
    return facts.join(listed, same & inside, "left").select(*facts.columns, *values)
