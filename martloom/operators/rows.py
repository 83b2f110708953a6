"""Row operators: projection, filters, membership, distinct, first-per-key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.casts import empty_to_null, marker_to_null, nan_to_null, NULL_MARKERS
from martloom.specs import TEXT, TableSpec


def project(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The columns of `spec`, in its order."""
    return df.select(*spec.columns)


def null_markers(
    df: DataFrame, markers: Sequence[str] = NULL_MARKERS, cols: Sequence[str] | None = None
) -> DataFrame:
    """Text equal to one of the missing markers becomes NULL (all text columns by default)."""
    chosen = cols or [f.name for f in df.schema.fields if f.dataType == TEXT]
    return df.withColumns({c: marker_to_null(F.col(c), tuple(markers)) for c in chosen})


def nan_values_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: nan_to_null(F.col(c)) for c in cols})


def empty_text_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: empty_to_null(F.col(c)) for c in cols})


def require_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows in which all of `cols` hold a value; unlike `dropna`, NaN counts as one."""
    return df.where(_all(F.col(c).isNotNull() for c in cols))


def require_positive(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.where(_all(F.col(c) > 0 for c in cols))


def require_text(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull() & (F.col(col) != ""))


def keep_known(df: DataFrame, ref: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of `df` whose `on` columns occur in `ref`.

    Catalyst broadcasts `ref` only while its measured size is below
    `spark.sql.autoBroadcastJoinThreshold`; beyond that both sides are shuffled and a hot key of
    `df` is split by the adaptive skew join, which may split the left side of a semi join.
    """
    return df.join(ref.select(*on), list(on), "left_semi").select(*df.columns)


def cascade_prune(
    items: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    product_on: str = "product_id",
    category_on: str = "product_category_name",
) -> DataFrame:
    """Order lines whose product has a known, non-empty category."""
    kept = keep_known(require_text(products, category_on), categories, [category_on])
    return keep_known(items, kept, [product_on])


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per `keys`: the one that is first by `order`; NULL keys form one group.

    Rows are reduced to one per key inside each input task before the shuffle, so a key that
    holds a third of the rows sends no more than one row per task.
    """
    picked = F.min_by(_rest(df, keys), F.struct(*_columns(order))).alias("_row")
    return _unpack(df.groupBy(*keys).agg(picked), df.columns, keys)


def smallest_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per `keys`: the smallest by the remaining columns, so the result is repeatable."""
    if len(keys) == len(df.columns):
        return df.distinct()
    return _unpack(df.groupBy(*keys).agg(F.min(_rest(df, keys)).alias("_row")), df.columns, keys)


def keep_latest(df: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """One row per `keys`: the one with the largest `seq`.

    The other columns break ties, so the result depends neither on partitioning nor on retries.
    """
    rest = [c for c in df.columns if c not in keys and c not in seq]
    latest = F.max(F.struct(*[F.col(c) for c in (*seq, *rest)])).alias("_row")
    return _unpack(df.groupBy(*keys).agg(latest), df.columns, keys)


def _rest(df: DataFrame, keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in df.columns if c not in keys])


def _unpack(grouped: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    return grouped.select(
        *[F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in columns]
    )


def _columns(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)
