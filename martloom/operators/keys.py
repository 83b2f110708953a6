"""Dense surrogate keys, numbered in the order of the natural key."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.shared import written

# `monotonically_increasing_id` holds the task number above its lower 33 bits.
_TASK_SHIFT = 33


def assign_keys(
    df: DataFrame,
    natural: Sequence[str],
    key: str,
    start: int = 0,
    key_type: str = "int",
    partitions: int | None = None,
    stored: bool = False,
) -> DataFrame:
    """Add `key` = start + 1 ... start + n, ascending by `natural` (unique, NULLs first).

    The rows are written once to the shared folder: the bounds of the range shuffle are sampled
    from that copy, so `df` is computed once whatever it costs. A `df` that only reads and filters a
    written table is `stored`: it is read twice and not copied. One range shuffle sorts the rows;
    each task numbers its own and the numbered rows are written again, which fixes them. The
    driver then sees one count per task, never a row, and the running total of the counts turns
    task positions into dense keys without any single-task sort.
    """
    if not stored:
        df = written(df, "unnumbered")
    order = [F.col(c).asc_nulls_first() for c in natural]
    spread = (partitions, *order) if partitions else order
    placed = written(
        df.repartitionByRange(*spread)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "keys",
    )
    task = F.shiftright("_slot", _TASK_SHIFT).cast("int")
    counts = dict(map(tuple, placed.groupBy(task.alias("task")).count().collect()))
    sizes = [counts.get(t, 0) for t in range(max(counts, default=0) + 1)]
    # one number per task, kept in the expression: the result then has the size statistics of
    # the written table, by which later joins decide whether to broadcast it
    before = F.split(F.lit(",".join(map(str, accumulate([start, *sizes])))), ",")
    base = F.get(before.cast("array<bigint>"), task)
    within = F.col("_slot").bitwiseAND(F.lit((1 << _TASK_SHIFT) - 1))
    number = base + within + 1
    too_large = F.raise_error(F.concat(F.lit(f"{key} outside {key_type}: "), number.cast("string")))
    return placed.select(
        F.coalesce(number.try_cast(key_type), too_large.cast(key_type)).alias(key), *df.columns
    )


def last_key(existing: DataFrame | None, key: str) -> int:
    if existing is None:
        return 0
    return existing.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]


def stable_keys(
    df: DataFrame,
    natural: Sequence[str],
    key: str,
    existing: DataFrame | None = None,
    key_type: str = "int",
) -> DataFrame:
    """(key, natural) for every natural key of `df` and of `existing`.

    A known natural key keeps its key; new ones continue after the largest key in use. NULL parts
    of a natural key are equal to each other.
    """
    fresh = df.select(*natural).distinct()
    if existing is None:
        return assign_keys(fresh, natural, key, key_type=key_type)
    known = existing.select(key, *natural)
    taken = known.select(*[F.col(c).alias(f"_known_{c}") for c in natural])
    same = [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in natural]
    fresh = fresh.join(taken, same, "left_anti")
    return known.unionByName(
        assign_keys(fresh, natural, key, start=last_key(existing, key), key_type=key_type)
    )
