"""Feature vectors held as arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def concat_features(*vectors: Column) -> Column:
    return F.concat(*vectors)


def take_features(vector: Column, start: int, size: int) -> Column:
    """`size` entries from 1-based position `start`."""
    return F.slice(vector, start, size)
