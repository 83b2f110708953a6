"""From raw text tables to clean, typed tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions import casts
from martloom.operators.rows import cascade_prune, dedup_first, keep_known, require_text
from martloom.sources.files import FAIL_LONG, INPUT_ORDER, read_csv_text
from martloom.specs import DOUBLE, INT, LONG, SOURCE_TABLES, TIME, TableSpec

# Tables in which only the first row of a key is kept, by position in the input.
FIRST_ROW_KEPT = ("geolocations", "order_reviews")


def typed_column(spec: TableSpec, name: str) -> Column:
    col, type_ = F.col(name), spec.types[name]
    if type_ == TIME:
        return casts.lenient_timestamp(col, spec.formats.get(name, casts.TIMESTAMP_PATTERN))
    if type_ == INT:
        return casts.lenient_int(col) if name in spec.lenient else casts.strict_int(col)
    if type_ == LONG:
        return casts.strict_int(col, "bigint")
    if type_ == DOUBLE:
        return casts.strict_double(col)
    return casts.empty_to_null(col) if name in spec.nullable else col


def type_table(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Text columns to the types of `spec`; other columns (the input order) are kept."""
    return raw.withColumns({c: typed_column(spec, c) for c in spec.columns})


def read_raw(
    spark: SparkSession,
    paths: Mapping[str, str],
    mode: str = FAIL_LONG,
    specs: Mapping[str, TableSpec] = SOURCE_TABLES,
) -> dict[str, DataFrame]:
    """The CSV file or folder of each table, in text columns."""
    return {
        name: read_csv_text(
            spark, path, specs[name], keep_order=name in FIRST_ROW_KEPT, mode=mode
        )
        for name, path in paths.items()
    }


def clean_tables(
    raw: Mapping[str, DataFrame], specs: Mapping[str, TableSpec] = SOURCE_TABLES
) -> dict[str, DataFrame]:
    """Typed tables, pruned and deduplicated.

    Products without a known category go, and with them their order lines; orders, payments and
    reviews stay as they are, so an order may be left without lines. Coordinates are compared as
    numbers, so `-23.50` and `-23.5` are one point.
    """
    typed = {name: type_table(df, specs[name]) for name, df in raw.items()}
    clean = dict(typed)
    for name in FIRST_ROW_KEPT:
        if name in typed:
            first = dedup_first(typed[name], specs[name].key, [INPUT_ORDER])
            clean[name] = first.drop(INPUT_ORDER)
    if "products" in typed:
        products, categories = typed["products"], typed["product_category_name_translation"]
        category = "product_category_name"
        clean["products"] = keep_known(require_text(products, category), categories, [category])
        if "order_items" in typed:
            clean["order_items"] = cascade_prune(typed["order_items"], products, categories)
    return clean


def ingest(
    spark: SparkSession,
    paths: Mapping[str, str],
    mode: str = FAIL_LONG,
    specs: Mapping[str, TableSpec] = SOURCE_TABLES,
) -> dict[str, DataFrame]:
    """`specs` may give other timestamp patterns (`TableSpec.formats`), `mode` is that of
    `read_csv_text`."""
    return clean_tables(read_raw(spark, paths, mode, specs), specs)
