import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martloom.functions import casts
from martloom.functions.calendar import calendar_columns
from martloom.functions.measures import density, volume
from martloom.functions.text import clean_controls, staged_text, truncate_text
from martloom.operators.rows import null_markers
from martloom.plans.ingest import type_table
from martloom.specs import TIME, TableSpec


def values(df):
    return [r[0] for r in df.collect()]


def apply(rows, texts, f, type_="string"):
    return values(rows([(t,) for t in texts], f"v {type_}").select(f(F.col("v"))))


def test_null_markers(rows):
    given = ["NA", "null", "nan", "N/A", "None", "", "<NA>", "-1.#IND", "Nan", "na", " ", "x", None]
    df = null_markers(rows([(g,) for g in given], "v string"))
    assert values(df) == [None] * 8 + ["Nan", "na", " ", "x", None]


def test_number_of_markers():
    assert len(set(casts.NULL_MARKERS)) == len(casts.NULL_MARKERS) == 19


def test_strict_int(rows):
    assert apply(rows, ["12", " 7 ", "1.5", "-1.5", "1e3"], casts.strict_int) == [12, 7, 1, -1, 1000]


@pytest.mark.parametrize("bad", ["x", None, "", "NaN", "1d", "0x1p3", "3000000000", "inf"])
def test_strict_int_fails(rows, bad):
    with pytest.raises(Exception, match="USER_RAISED_EXCEPTION|not a whole number|outside int"):
        apply(rows, ["1", bad], casts.strict_int)


def test_strict_bigint_keeps_all_digits(rows):
    as_long = lambda c: casts.strict_int(c, "bigint")
    assert apply(rows, ["9007199254740993", "-9223372036854775808"], as_long) == [
        9007199254740993,
        -9223372036854775808,
    ]
    assert apply(rows, ["9223372036854775807", "7.9", "1e3"], as_long) == [2**63 - 1, 7, 1000]


@pytest.mark.parametrize(
    "bad", ["9223372036854775808", "9223372036854775900", "-9223372036854775809", "9223372036854775808.0", "1e19"]
)
def test_bigint_out_of_range_fails(rows, bad):
    with pytest.raises(Exception, match="outside bigint"):
        apply(rows, ["1", bad], lambda c: casts.strict_int(c, "bigint"))


def test_strict_double(rows):
    assert apply(rows, ["1.5", " -2e-3 ", None], casts.strict_double) == [1.5, -0.002, None]
    for bad in ("1.5f", "Nan", ""):
        with pytest.raises(Exception, match="not a number"):
            apply(rows, [bad], casts.strict_double)


def test_lenient_int(rows):
    given = ["12", "12.9", "-12.9", "x", "NaN", None, "", "5d"]
    assert apply(rows, given, casts.lenient_int) == [12, 12, -12] + [None] * 5
    with pytest.raises(Exception, match="outside int"):
        apply(rows, ["1e12"], casts.lenient_int)


def test_lenient_timestamp(rows):
    given = [
        "2017-09-19 09:45:35",
        "2017-09-19",
        "2017-02-30 00:00:00",
        "2017-09-19T09:45:35",
        "junk",
        "9999-12-31 00:00:00",
        "2017-09-19 09:45:35.5",
        None,
    ]
    found = apply(rows, given, casts.lenient_timestamp)
    assert found == [dt.datetime(2017, 9, 19, 9, 45, 35), None, None, None, None,
                     dt.datetime(9999, 12, 31), None, None]
    assert apply(rows, ["2300-01-01 00:00:00", "1500-03-01 00:00:00"], casts.lenient_timestamp) == [
        dt.datetime(2300, 1, 1), dt.datetime(1500, 3, 1)
    ]


def test_timestamp_patterns(rows):
    def of(pattern, *texts):
        return apply(rows, list(texts), lambda c: casts.lenient_timestamp(c, pattern))

    assert of("yyyy-MM-dd", "2017-09-19", "2017-02-30", "2017-09-19 01:02:03", None) == [
        dt.datetime(2017, 9, 19), None, None, None
    ]
    assert of("dd/MM/yyyy HH:mm", "19/09/2017 23:59", "2017-09-19", "40/09/2017 10:00") == [
        dt.datetime(2017, 9, 19, 23, 59), None, None
    ]


def test_pattern_of_a_column_comes_from_its_table(rows):
    spec = TableSpec("t", dict(day=TIME, at=TIME), key=(), formats={"day": "yyyy-MM-dd"})
    got = type_table(rows([("2017-09-19", "2017-09-19 01:00:00")], "day string, at string"), spec)
    assert tuple(got.first()) == (dt.datetime(2017, 9, 19), dt.datetime(2017, 9, 19, 1))


def test_lenient_timestamp_ignores_the_session_zone(spark, rows):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = apply(rows, ["2017-03-12 02:30:00"], casts.lenient_timestamp)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == [dt.datetime(2017, 3, 12, 2, 30)]


def test_missing_values(rows):
    assert apply(rows, [1.0, float("nan"), None], casts.nan_to_null, "double") == [1.0, None, None]
    assert apply(rows, ["a", "", None], casts.empty_to_null) == ["a", None, None]


def test_money_rounds_halves_away_from_zero(rows):
    given = [0.125, -0.125, 2.675, 1.005, 3.0]
    expected = [Decimal(t) for t in ("0.13", "-0.13", "2.68", "1.01", "3.00")]
    assert apply(rows, given, casts.money, "double") == expected
    for bad in (1e10, float("nan")):
        with pytest.raises(Exception, match="no amount"):
            apply(rows, [bad], casts.money, "double")


def test_clean_controls(rows):
    given = ["a\tb", "a\nb", "a\rb", "a\r\nb", None, ""]
    assert apply(rows, given, clean_controls) == ["a b", "a b", "a b", "a  b", None, ""]


def test_truncate_counts_characters(rows):
    given = ["x" * 254, "x" * 255, "x" * 256, "é" * 255, "é" * 300, None]
    found = apply(rows, given, truncate_text)
    assert [v and len(v) for v in found] == [254, 255, 255, 255, 255, None]
    assert apply(rows, ["\t" * 300], staged_text) == [" " * 255]


def test_calendar_equals_python(spark):
    first, last = dt.date(1990, 1, 1), dt.date(2060, 12, 31)
    days = spark.range((last - first).days + 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("d")
    )
    for row in days.select(*calendar_columns(F.col("d"))).toLocalIterator():
        d = row.full_date
        iso = d.isocalendar()
        assert tuple(row) == (
            int(d.strftime("%Y%m%d")),
            d,
            iso.year,
            (d.month + 2) // 3,
            d.month,
            d.day,
            iso.weekday,
            d.strftime("%A"),
            iso.week,
            iso.weekday > 5,
        )


def test_volume_and_density(rows):
    df = rows([(2, 3, 4, 12), (None, 3, 4, 1)], "l int, h int, w int, g int")
    space = volume(F.col("l"), F.col("h"), F.col("w"))
    found = df.select(space.alias("v"), density(F.col("g"), space).alias("d")).collect()
    assert [tuple(r) for r in found] == [(24, 0.5), (None, None)]
    big = rows([(2000, 2000, 2000)], "l int, h int, w int")
    with pytest.raises(Exception, match="volume outside int"):
        big.select(volume(F.col("l"), F.col("h"), F.col("w"))).collect()
