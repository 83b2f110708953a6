"""Column expressions that turn text into typed values."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text the frame reader takes as missing when no other list is given.
NULL_MARKERS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# The parts of a timestamp pattern, with what each looks like in text.
_PATTERN_PARTS = {
    "yyyy": r"\d{4}", "MM": r"\d{2}", "dd": r"\d{2}",
    "HH": r"\d{2}", "mm": r"\d{2}", "ss": r"\d{2}",
}
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"

# What a CSV number looks like. The shapes are tested before the cast: Java alone would also read
# `1d` or `0x1p3`, and a cast that fails raises and catches an error for every such row.
_NUMBER_SHAPE = (
    r"^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity))\s*$"
)
# Numbers whose part before the point is the whole number that they are cut to.
_PLAIN_SHAPE = r"^\s*[+-]?\d+(?:\.\d*)?\s*$"
# Ends of the whole number types as doubles: a double at or beyond them would saturate in a cast.
_LIMIT = {"int": 2.0**31, "bigint": 2.0**63}


def marker_to_null(col: Column, markers: tuple[str, ...] = NULL_MARKERS) -> Column:
    return F.when(~col.isin(*markers), col)


def empty_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def nan_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(float("nan")))


def lenient_double(col: Column) -> Column:
    """Number in the text, NULL for anything else (`NaN` included)."""
    return F.when(col.rlike(_NUMBER_SHAPE), col).try_cast("double")


def lenient_int(col: Column) -> Column:
    """As `lenient_double`, cut to a whole number; a number outside INT fails."""
    return F.coalesce(_plain(col, "int"), _cut(lenient_double(col), "int"))


def strict_double(col: Column) -> Column:
    """Number in the text; missing stays NULL, other text fails the job."""
    return F.coalesce(lenient_double(col), F.when(col.isNotNull(), _fail("not a number", col)))


def strict_int(col: Column, type_: str = "int") -> Column:
    """Number in the text cut to a whole one; missing or other text fails the job."""
    return F.coalesce(
        _plain(col, type_), _cut(lenient_double(col), type_), _fail("not a whole number", col)
    )


def lenient_timestamp(col: Column, pattern: str = TIMESTAMP_PATTERN) -> Column:
    """Timestamp without zone in text of the given pattern; any other text is NULL.

    A pattern consists of yyyy, MM, dd, HH, mm, ss and other signs, which stand for themselves; a
    column of dates only has a pattern without HH, mm and ss.
    """
    pieces = re.split("(" + "|".join(_PATTERN_PARTS) + ")", pattern)
    shape = "".join(_PATTERN_PARTS.get(p) or re.escape(p) for p in pieces)
    if pattern == TIMESTAMP_PATTERN:
        iso = col
    else:
        # text of this shape has every part at a fixed place
        place = {p: len("".join(pieces[:i])) + 1 for i, p in enumerate(pieces) if p in _PATTERN_PARTS}

        def part(name: str) -> Column:
            return F.substring(col, place[name], len(name)) if name in place else F.lit("00")

        iso = F.concat(
            F.concat_ws("-", part("yyyy"), part("MM"), part("dd")), F.lit(" "),
            F.concat_ws(":", part("HH"), part("mm"), part("ss")),
        )
    return F.when(col.rlike(f"^{shape}$"), iso).try_cast("timestamp_ntz")


def money(col: Column) -> Column:
    """DECIMAL(12,2), halves rounded away from zero; an amount that does not fit fails."""
    return F.coalesce(
        col.try_cast("decimal(12,2)"), F.when(col.isNotNull(), _fail("no amount", col))
    )


def _plain(col: Column, type_: str) -> Column:
    """Numbers without exponent, read exactly from the digits before the point; what the type can't
    hold is left to fail in `_cut`."""
    whole = F.substring_index(col, ".", 1)
    return F.when(col.rlike(_PLAIN_SHAPE), whole).try_cast(type_)


def _cut(number: Column, type_: str) -> Column:
    """Reached only by text whose digits before the point are no number of `type_`."""
    inside = (number > -_LIMIT[type_] - 1) & (number < _LIMIT[type_])
    return F.coalesce(
        F.when(inside, number).try_cast(type_),
        F.when(number.isNotNull(), _fail(f"outside {type_}", number)),
    )


def _fail(reason: str, col: Column) -> Column:
    shown = F.coalesce(col.cast("string"), F.lit("NULL"))
    return F.raise_error(F.concat(F.lit(f"{reason}: "), shown))
