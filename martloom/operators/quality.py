"""Checks of what Spark does not enforce: keys, references, required values, text lengths."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.specs import TableSpec


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def fk_orphans(
    child: DataFrame, parent: DataFrame, on: Mapping[str, str] | Sequence[str]
) -> DataFrame:
    """Child rows without a parent row; a NULL in the reference makes it no orphan.

    `on` maps child columns to parent columns, or names the columns they share.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    targets = parent.select(*[F.col(p).alias(f"_parent_{c}") for c, p in pairs.items()])
    matched = reduce(
        lambda a, b: a & b, [F.col(c) == F.col(f"_parent_{c}") for c in pairs]
    )
    stated = child.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in pairs]))
    return stated.join(targets, matched, "left_anti")


def null_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Number of NULLs in each of `cols`, in one pass over the table."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counted.unpivot([], list(cols), "column_name", "n_nulls")


def length_violations(
    df: DataFrame, limits: Mapping[str, int], keys: Sequence[str], unit: str = "characters"
) -> DataFrame:
    """One row per value longer than its limit; `unit` is `characters` or `bytes`."""
    if unit not in ("characters", "bytes"):
        raise ValueError(f"unknown length unit {unit!r}")
    size = F.length if unit == "characters" else F.octet_length
    found = [
        F.struct(
            F.lit(c).alias("column_name"),
            size(F.col(c)).alias("found_length"),
            F.lit(n).alias("max_length"),
        )
        for c, n in limits.items()
    ]
    long_ones = F.filter(F.array(*found), lambda v: v["found_length"] > v["max_length"])
    return df.select(*keys, F.inline(long_ones))


def check_table(df: DataFrame, spec: TableSpec, parents: Mapping[str, DataFrame]) -> DataFrame:
    """All checks of one table as (table_name, check_name, subject, n_violations).

    Required values and lengths share one pass; every key and reference takes a shuffle of its own.
    """
    measures = [
        *[("not_null", c, F.count_if(F.col(c).isNull())) for c in spec.required],
        *[("length", c, F.count_if(F.length(c) > n)) for c, n in spec.text_limits.items()],
    ]
    one_pass = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(check).alias("check_name"),
                    F.lit(subject).alias("subject"),
                    n.alias("n_violations"),
                )
                for check, subject, n in measures
            ]
        ).alias("found")
    ).select(F.inline("found"))

    def counted(bad: DataFrame, check: str, subject: str) -> DataFrame:
        return bad.agg(F.count(F.lit(1)).alias("n_violations")).select(
            F.lit(check).alias("check_name"), F.lit(subject).alias("subject"), "n_violations"
        )

    parts = [one_pass, counted(key_violations(df, spec.key), "key", ",".join(spec.key))]
    for ref in spec.references:
        if ref.parent in parents:
            orphans = fk_orphans(
                df, parents[ref.parent], dict(zip(ref.columns, ref.parent_columns))
            )
            parts.append(counted(orphans, "reference", ref.parent))
    return reduce(DataFrame.unionByName, parts).select(F.lit(spec.name).alias("table_name"), "*")
