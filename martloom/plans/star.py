"""Builders of the dimension tables, the calendar and the order-line fact."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.calendar import calendar_columns
from martloom.functions.casts import money
from martloom.functions.measures import density, volume
from martloom.operators.keys import assign_keys, last_key
from martloom.operators.lookup import lookup_key, translate_category
from martloom.operators.merge import new_rows, single_per_key, update_matched
from martloom.operators.rows import (
    distinct_rows,
    project,
    require_not_null,
    require_positive,
    smallest_per_key,
)
from martloom.shared import side_by_side, written
from martloom.specs import (
    DIM_CUSTOMER,
    DIM_GEOLOCATION,
    DIM_ORDER_STATUS,
    DIM_PAYMENT_TYPE,
    DIM_PRODUCT,
    DIM_SELLER,
    FACT_ORDER_ITEM,
    TableSpec,
)

UNKNOWN_KEY = -1

PRODUCT_MEASURES = (
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
)


def _insert_dimension(
    src: DataFrame,
    spec: TableSpec,
    natural: str,
    required: Sequence[str],
    existing: DataFrame | None,
    key_type: str,
) -> DataFrame:
    """Known rows as they are; new natural keys get keys after the largest one in use."""
    (key,) = spec.key
    given = require_not_null(src.select(*spec.columns[1:]), required)
    if existing is None:
        rows = smallest_per_key(given, [natural])
        return project(assign_keys(rows, [natural], key, key_type=key_type), spec)
    fresh = new_rows(existing, given, [natural])
    keyed = assign_keys(fresh, [natural], key, last_key(existing, key), key_type)
    return existing.select(*spec.columns).unionByName(keyed)


def build_dim_customer(
    customers: DataFrame, existing: DataFrame | None = None, key_type: str = "int"
) -> DataFrame:
    required = DIM_CUSTOMER.columns[2:]
    return _insert_dimension(customers, DIM_CUSTOMER, "customer_id", required, existing, key_type)


def build_dim_seller(
    sellers: DataFrame, existing: DataFrame | None = None, key_type: str = "int"
) -> DataFrame:
    required = DIM_SELLER.columns[2:]
    return _insert_dimension(sellers, DIM_SELLER, "seller_id", required, existing, key_type)


def build_dim_payment_type(
    payments: DataFrame, existing: DataFrame | None = None, key_type: str = "int"
) -> DataFrame:
    name = "payment_type"
    return _insert_dimension(payments, DIM_PAYMENT_TYPE, name, [name], existing, key_type)


def build_dim_order_status(
    orders: DataFrame, existing: DataFrame | None = None, key_type: str = "int"
) -> DataFrame:
    name = "order_status"
    return _insert_dimension(orders, DIM_ORDER_STATUS, name, [name], existing, key_type)


def build_dim_geolocation(
    geolocations: DataFrame, existing: DataFrame | None = None, key_type: str = "int"
) -> DataFrame:
    """Distinct places, appended to the existing ones whether known or not."""
    places = DIM_GEOLOCATION.columns[1:]
    given = distinct_rows(require_not_null(geolocations, places[:3]), places)
    key = "geolocation_key"
    keyed = assign_keys(given, places, key, last_key(existing, key), key_type)
    fresh = project(keyed, DIM_GEOLOCATION)
    return fresh if existing is None else existing.select(*fresh.columns).unionByName(fresh)


def build_dim_product(
    products: DataFrame,
    translation: DataFrame,
    existing: DataFrame | None = None,
    on_dup: str = "error",
    key_type: str = "int",
) -> DataFrame:
    """Products with known category and positive measures, merged into the existing ones.

    A known product keeps its key and takes the new category and measures; volume and density
    follow the measures.
    """
    columns = DIM_PRODUCT.columns[1:8]
    named = translate_category(products, translation).withColumnRenamed(
        "product_category_name_english", "product_english_category_name"
    )
    given = require_positive(require_not_null(named, columns[1:]), PRODUCT_MEASURES)
    given = single_per_key(given.select(*columns), ["product_id"], on_dup)
    if existing is None:
        rows = assign_keys(given, ["product_id"], "product_key", key_type=key_type)
    else:
        given = written(given, "given")  # read twice below
        known = update_matched(
            existing.select("product_key", *columns), given, ["product_id"], columns[1:]
        )
        fresh = given.join(existing.select("product_id"), "product_id", "left_anti")
        start = last_key(existing, "product_key")
        rows = known.unionByName(
            assign_keys(fresh, ["product_id"], "product_key", start, key_type)
        )
    space = volume(*[F.col(c) for c in PRODUCT_MEASURES[1:]])
    return project(
        rows.withColumn("product_volume_cm3", space).withColumn(
            "product_density_g_per_cm3",
            density(F.col("product_weight_g"), F.col("product_volume_cm3")),
        ),
        DIM_PRODUCT,
    )


def build_dim_time(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day from `start` to `end`, both included; none when `start` is later."""
    days = spark.range(max(0, (end - start).days + 1))
    dates = days.select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date"))
    return dates.select(*calendar_columns(F.col("full_date")))


def build_dim_time_of(df: DataFrame, column: str) -> DataFrame:
    """The calendar from the first to the last day that occurs in `column`."""
    first, last = df.agg(
        F.min(F.col(column).cast("date")), F.max(F.col(column).cast("date"))
    ).first()
    if first is None:
        first, last = dt.date(1970, 1, 2), dt.date(1970, 1, 1)
    return build_dim_time(df.sparkSession, first, last)


def _looked_up(
    items: DataFrame, orders: DataFrame, dims: Mapping[str, DataFrame]
) -> DataFrame:
    """Order lines with their four keys, NULL where a lookup fails.

    Customer and status are looked up once per order, which is the smaller side, and reach the
    lines in the one join on `order_id`.
    """
    order_keys = orders.select(
        F.col("order_id").alias("_order_id"), "customer_id", "order_status"
    )
    order_keys = lookup_key(
        order_keys, dims["dim_order_status"], "order_status", "order_status_key", how="left"
    )
    order_keys = lookup_key(
        order_keys, dims["dim_customer"], "customer_id", "customer_key", how="left"
    ).select("_order_id", "customer_key", "order_status_key")
    lines = items.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        money(F.col("price")).alias("item_price"),
        money(F.col("freight_value")).alias("freight_value"),
    )
    lines = lookup_key(lines, dims["dim_product"], "product_id", "product_key", how="left")
    lines = lookup_key(lines, dims["dim_seller"], "seller_id", "seller_key", how="left")
    return lines.join(order_keys, F.col("order_id") == F.col("_order_id"), "left")


LOOKUPS = ("product_key", "customer_key", "seller_key", "order_status_key")


def build_fact_order_item(
    items: DataFrame,
    orders: DataFrame,
    dims: Mapping[str, DataFrame],
    on_missing: str = "drop",
    existing: DataFrame | None = None,
) -> DataFrame:
    """One row per order line with its dimension keys and amounts.

    `items` is unique in (order_id, order_item_id). A line whose lookup fails is dropped
    (`fact_rejects` lists it) or points at the unknown member -1. Lines of `existing` keep their
    key and take the new values where `items` holds them again; only new lines are sorted and
    numbered.
    """
    return number_lines(fact_lines(items, orders, dims, on_missing), existing)


def fact_lines(
    items: DataFrame,
    orders: DataFrame,
    dims: Mapping[str, DataFrame],
    on_missing: str = "drop",
) -> DataFrame:
    """The rows of the fact table before they are numbered. Several runs over the same orders and
    dimensions can share them, written once."""
    rows = _looked_up(items, orders, dims)
    if on_missing == "drop":
        rows = require_not_null(rows, LOOKUPS)
    elif on_missing == "unknown":
        rows = rows.withColumns({k: F.coalesce(k, F.lit(UNKNOWN_KEY)) for k in LOOKUPS})
    else:
        raise ValueError(f"unknown on_missing {on_missing!r}")
    return rows.select(*FACT_ORDER_ITEM.columns[1:])


def number_lines(
    rows: DataFrame, existing: DataFrame | None = None, stored: bool = False
) -> DataFrame:
    """`rows` of `fact_lines` with their keys, merged into `existing`; `stored` says that they only
    read and filter a written table."""
    line, key = ["order_id", "order_item_id"], "order_item_fact_key"
    if existing is None:
        keyed = assign_keys(rows, line, key, key_type="long", stored=stored)
        return project(keyed, FACT_ORDER_ITEM)
    # one join tells new lines from known ones; it is written with one value of each column, and
    # only the new lines are sorted
    values = rows.columns[2:]
    old = existing.select(key, *line, *[F.col(c).alias(f"_old_{c}") for c in values])
    taken = [F.when(F.col("_new"), F.col(c)).otherwise(F.col(f"_old_{c}")).alias(c) for c in values]
    both = old.join(rows.withColumn("_new", F.lit(True)), line, "full_outer")
    both = written(both.select(key, *line, *taken), "lines")
    known, fresh = both.where(F.col(key).isNotNull()), both.where(F.col(key).isNull()).drop(key)
    start = last_key(known, key)
    return known.unionByName(assign_keys(fresh, line, key, start, key_type="long", stored=True))


def fact_rejects(
    items: DataFrame, orders: DataFrame, dims: Mapping[str, DataFrame]
) -> DataFrame:
    """Order lines that `build_fact_order_item` drops, with the keys that were not found."""
    missing = F.array_compact(F.array(*[F.when(F.col(k).isNull(), F.lit(k)) for k in LOOKUPS]))
    return (
        _looked_up(items, orders, dims)
        .select("order_id", "order_item_id", missing.alias("missing_keys"))
        .where(F.size("missing_keys") > 0)
    )


def build_star(
    tables: Mapping[str, DataFrame],
    existing: Mapping[str, DataFrame] | None = None,
    on_missing: str = "drop",
) -> dict[str, DataFrame]:
    """All star tables from the clean source tables; the calendar spans the order dates."""
    known = (existing or {}).get
    names = tables["product_category_name_translation"]
    jobs = {
        "dim_customer": lambda: build_dim_customer(tables["customers"], known("dim_customer")),
        "dim_seller": lambda: build_dim_seller(tables["sellers"], known("dim_seller")),
        "dim_geolocation": lambda: build_dim_geolocation(
            tables["geolocations"], known("dim_geolocation")
        ),
        "dim_product": lambda: build_dim_product(tables["products"], names, known("dim_product")),
        "dim_order_status": lambda: build_dim_order_status(
            tables["orders"], known("dim_order_status")
        ),
        "dim_payment_type": lambda: build_dim_payment_type(
            tables["order_payments"], known("dim_payment_type")
        ),
        "dim_time": lambda: build_dim_time_of(tables["orders"], "order_purchase_timestamp"),
    }
    star = side_by_side(tables["orders"].sparkSession, jobs)
    star["fact_order_item"] = build_fact_order_item(
        tables["order_items"], tables["orders"], star, on_missing, known("fact_order_item")
    )
    return star
