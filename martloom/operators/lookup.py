"""Joins against tables with a unique key: translation, key lookup, parent and child."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def translate_category(
    products: DataFrame, translation: DataFrame, on: str = "product_category_name"
) -> DataFrame:
    """Products with the English name of their category; unknown categories drop out."""
    names = [c for c in translation.columns if c != on]
    return products.join(translation, on, "inner").select(*products.columns, *names)


def lookup_key(
    df: DataFrame,
    dim: DataFrame,
    natural: str,
    key: str,
    on: str | None = None,
    how: str = "inner",
) -> DataFrame:
    """Add the surrogate `key` of the dimension row whose `natural` equals `on` of `df`.

    `dim` is unique in `natural`, so rows never multiply. No hint is given: Catalyst broadcasts
    the two looked-up columns when their measured size allows it; otherwise both sides are
    shuffled and the adaptive skew join splits a hot key of `df`.
    """
    pairs = dim.select(F.col(natural).alias("_natural"), F.col(key).alias(key))
    return df.join(pairs, F.col(on or natural) == F.col("_natural"), how).drop("_natural")


def with_children(
    parent: DataFrame, child: DataFrame, on: str, child_on: str | None = None
) -> DataFrame:
    """Every parent with each of its children, one row per pair; childless parents once.

    Child columns that share a name with a parent column are prefixed `child_`. The pairs come
    from an inner join, whose child side can be split where one parent owns a large share of the
    children, and the childless parents from an anti join against the distinct references, so no
    group of children is ever gathered in one place.
    """
    ref = child_on or on
    renamed = child.select(
        F.col(ref).alias("_ref"),
        *[
            F.col(c).alias(f"child_{c}" if c in parent.columns else c)
            for c in child.columns
            if c != ref
        ],
    )
    pairs = parent.join(renamed, F.col(on) == F.col("_ref"), "inner").drop("_ref")
    owners = child.select(F.col(ref).alias("_ref")).distinct()
    childless = parent.join(owners, F.col(on) == F.col("_ref"), "left_anti")
    return pairs.unionByName(childless, allowMissingColumns=True)


def with_child_counts(
    parent: DataFrame, child: DataFrame, on: str, count: str, child_on: str | None = None
) -> DataFrame:
    """Every parent with its number of children, counted before the join."""
    counts = child.groupBy(F.col(child_on or on).alias("_ref")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    return parent.join(counts, F.col(on) == F.col("_ref"), "left").select(
        *parent.columns, F.coalesce("_n", F.lit(0)).alias(count)
    )


def with_single_child(
    parent: DataFrame, child: DataFrame, on: str, cols: Sequence[str], child_on: str | None = None
) -> DataFrame:
    """Every parent with `cols` of its only child; a second child fails the job."""
    ref = child_on or on
    one = child.groupBy(F.col(ref).alias("_ref")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct(*cols)).alias("_child")
    )
    message = F.concat(F.lit("more than one child for "), F.col("_ref").cast("string"))
    single = one.where(
        F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(True)
    )
    return parent.join(single, F.col(on) == F.col("_ref"), "left").select(
        *parent.columns, *[F.col("_child").getField(c).alias(c) for c in cols]
    )
