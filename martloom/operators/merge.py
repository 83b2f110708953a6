"""Merges as joins: the target and the incoming rows give the next state of the target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.rows import keep_latest, smallest_per_key


def new_rows(target: DataFrame, src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key of `src` that `target` does not hold; the smallest where keys repeat."""
    fresh = smallest_per_key(src, keys).join(target.select(*keys), list(keys), "left_anti")
    return fresh.select(*src.columns)


def insert_if_absent(target: DataFrame, src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows untouched, plus the rows of `src` with a new key."""
    return target.unionByName(new_rows(target, src, keys), allowMissingColumns=True)


def single_per_key(src: DataFrame, keys: Sequence[str], on_dup: str = "error") -> DataFrame:
    """`src` with unique keys: a repeated key fails the job, or (`smallest`) one row is taken."""
    if on_dup == "smallest":
        return smallest_per_key(src, keys)
    if on_dup != "error":
        raise ValueError(f"unknown on_dup {on_dup!r}")
    rest = [c for c in src.columns if c not in keys]
    counted = src.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct(*rest)).alias("_row")
    )
    shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    repeated = F.raise_error(F.concat(F.lit("key given twice in one batch: "), shown))
    checked = counted.where(F.when(F.col("_n") > 1, repeated.cast("boolean")).otherwise(True))
    return checked.select(
        *[F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in src.columns]
    )


def update_matched(
    target: DataFrame, src: DataFrame, keys: Sequence[str], set_cols: Sequence[str]
) -> DataFrame:
    """All target rows; those with a row in `src` (unique keys) take its `set_cols`."""
    given = src.select(*keys, F.struct(*set_cols).alias("_new"))
    return target.join(given, list(keys), "left").select(
        *[
            F.when(F.col("_new").isNotNull(), F.col("_new").getField(c)).otherwise(F.col(c)).alias(c)
            if c in set_cols
            else F.col(c)
            for c in target.columns
        ]
    )


def upsert(
    target: DataFrame,
    src: DataFrame,
    keys: Sequence[str],
    set_cols: Sequence[str],
    on_dup: str = "error",
) -> DataFrame:
    """Matched rows take `set_cols`, all other columns keep their old values; new rows follow.

    A new row holds NULL in the target columns that `src` lacks.
    """
    given = single_per_key(src, keys, on_dup)
    inserted = [c for c in target.columns if c in given.columns and c not in keys]
    old = target.select(*keys, F.struct(*[c for c in target.columns if c not in keys]).alias("_old"))
    new = given.select(*keys, F.struct(*inserted).alias("_new"))
    known, present = F.col("_old").isNotNull(), F.col("_new").isNotNull()

    def value(c: str):
        if c in keys:
            return F.col(c)
        kept = F.col("_old").getField(c)
        if c not in inserted:
            return kept.alias(c)
        incoming = F.col("_new").getField(c)
        takes = present if c in set_cols else present & ~known
        return F.when(takes, incoming).otherwise(kept).alias(c)

    return old.join(new, list(keys), "full_outer").select(*[value(c) for c in target.columns])


def append_distinct(target: DataFrame, src: DataFrame) -> DataFrame:
    """Target rows plus the distinct rows of `src`, known or not: running twice doubles them."""
    return target.unionByName(src.distinct())


def latest_changes(
    changes: DataFrame, keys: Sequence[str], seq: Sequence[str], op: str
) -> DataFrame:
    """The last change of every key."""
    return keep_latest(changes, keys, (*seq, op))


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    seq: Sequence[str],
    op: str,
    delete: str = "delete",
) -> DataFrame:
    """Fold change rows into `target`; of a delete row only the key columns are read."""
    last = latest_changes(changes, keys, seq, op)
    untouched = target.join(last.select(*keys), list(keys), "left_anti")
    alive = last.where(F.col(op) != delete)
    return untouched.select(*target.columns).unionByName(alive.select(*target.columns))
