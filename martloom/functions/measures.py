"""Derived product measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def volume(length: Column, height: Column, width: Column) -> Column:
    """Product of the three sides as INT; a volume outside INT fails rather than wraps."""
    exact = length.cast("decimal(10,0)") * height.cast("decimal(10,0)")
    wide = exact.cast("decimal(20,0)") * width.cast("decimal(10,0)")
    fitted = wide.try_cast("int")
    return F.when(
        wide.isNotNull() & fitted.isNull(),
        F.raise_error(F.concat(F.lit("volume outside int: "), wide.cast("string"))),
    ).otherwise(fitted)


def density(weight: Column, volume_: Column) -> Column:
    return weight.cast("double") / volume_.cast("double")
