"""Reading the given tables, and the row key of tables whose ids may be missing or repeated."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text modulo `modulus`; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string")) % modulus


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def fill_slots(spark: SparkSession) -> int:
    """Partitions for work of Python tasks on few bytes of input: as the session shuffles."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_key(doc_id: str, text: str) -> list[Column]:
    """128 bits that stand for an id and its text, never NULL; equal only for equal rows."""
    parts = [F.col(doc_id).isNull(), F.col(doc_id), F.col(text).isNull(), F.col(text)]
    return [F.xxhash64(F.lit(n), *parts).alias(f"k{n}") for n in (1, 2)]


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with so many underscores before it that no column of `df` has it."""
    taken = {c.lower() for c in df.columns}
    longest = max((len(c) - len(c.lstrip("_")) for c in taken), default=0)
    return [n if n.lower() not in taken else "_" * (longest + 1) + n for n in names]


def text_ranges(texts: list[str], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts that have about `most` characters together, or a single longer text."""
    start, size = 0, 0
    for at, text in enumerate(texts):
        if size and size + len(text) > most:
            yield start, at
            start, size = at, 0
        size += len(text) + 1
    if size:
        yield start, len(texts)
