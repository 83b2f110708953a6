"""Bounded scans and buffered writes of database tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.specs import TableSpec

# Rows per write of the buffered sink.
FLUSH_ROWS = 10_000


@dataclass(frozen=True)
class NumericSplit:
    """Even stripes of a number, date or timestamp column."""

    column: str
    lower: str | int
    upper: str | int
    partitions: int


@dataclass(frozen=True)
class TextSplit:
    """Ranges of a text key between the given bounds, for tables keyed by text."""

    column: str
    bounds: Sequence[str]


def hex_bounds(partitions: int, digits: int = 4) -> list[str]:
    """Bounds that cut lower-case hexadecimal keys into ranges of equal width."""
    width = 16**digits
    return [f"{i * width // partitions:0{digits}x}" for i in range(1, partitions)]


def range_predicates(column: str, bounds: Sequence[str]) -> list[str]:
    """WHERE clauses that together hold every row exactly once, NULL included."""
    quoted = ["'" + b.replace("'", "''") + "'" for b in sorted(set(bounds))]
    if not quoted:
        return ["1 = 1"]
    inner = [
        f"{column} >= {low} AND {column} < {high}" for low, high in zip(quoted, quoted[1:])
    ]
    return [
        f"{column} < {quoted[0]} OR {column} IS NULL",
        *inner,
        f"{column} >= {quoted[-1]}",
    ]


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    spec: TableSpec,
    split: NumericSplit | TextSplit | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """The table with the columns and types of `spec`, one task per stripe of `split`.

    Filters and column lists are pushed into the database; without `split` one task reads all.
    """
    options = {"preferTimestampNTZ": "true", "fetchsize": str(FLUSH_ROWS), **(properties or {})}
    if isinstance(split, TextSplit):
        rows = spark.read.jdbc(
            url,
            table,
            predicates=range_predicates(split.column, split.bounds),
            properties=options,
        )
    elif split is not None:
        rows = spark.read.jdbc(
            url,
            table,
            column=split.column,
            lowerBound=split.lower,
            upperBound=split.upper,
            numPartitions=split.partitions,
            properties=options,
        )
    else:
        rows = spark.read.jdbc(url, table, properties=options)
    return rows.select(*[F.col(c).cast(t).alias(c) for c, t in spec.types.items()])


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    properties: Mapping[str, str] | None = None,
) -> None:
    """Buffered insert from every task; a retried task repeats rows, so the target needs a key."""
    options = {"batchsize": str(FLUSH_ROWS), **(properties or {})}
    df.write.jdbc(url, table, mode=mode, properties=options)
