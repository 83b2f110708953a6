"""Queries for joins, surrogate keys, dimensions, calendar and fact."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from checks import standins as S
from checks.standins import table, with_tables
from martloom.operators import lookup as L
from martloom.operators.keys import stable_keys as assign_stable_keys
from martloom.operators.rows import smallest_per_key
from martloom.plans import star
from martloom.shared import side_by_side, written

LINE_KEY = ["order_id", "order_item_id"]


def translate_category(spark, sf_dir):
    return L.translate_category(S.products(spark, sf_dir), S.translation(spark, sf_dir)).select(
        "product_id", "product_category_name_english", "product_category_name"
    )


def lookup_key(spark, sf_dir):
    dim = star.build_dim_seller(S.sellers(spark, sf_dir))
    lines = S.order_items_raw(spark, sf_dir).select(*LINE_KEY, "product_id", "seller_id")
    return L.lookup_key(lines, dim, "seller_id", "seller_key")


def parent_child(spark, sf_dir):
    orders = S.source_orders(spark, sf_dir).select("order_id", "order_status")
    return L.with_children(orders, S.order_items_raw(spark, sf_dir), "order_id")


def child_counts(spark, sf_dir):
    customers, orders = S.customers(spark, sf_dir), S.source_orders(spark, sf_dir)
    counted = L.with_child_counts(customers, orders, "customer_id", "n_orders")
    return counted.select("customer_id", "n_orders")


def single_child(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return L.with_single_child(docs, labels, "doc_id", ["quality", "toxic"])


def dim_customer(spark, sf_dir):
    return star.build_dim_customer(S.customers(spark, sf_dir))


def dim_seller(spark, sf_dir):
    return star.build_dim_seller(S.sellers(spark, sf_dir))


def dim_geolocation(spark, sf_dir):
    return star.build_dim_geolocation(S.geolocations(spark, sf_dir))


def dim_payment_type(spark, sf_dir):
    return star.build_dim_payment_type(S.order_payments(spark, sf_dir))


def dim_order_status(spark, sf_dir):
    return star.build_dim_order_status(S.source_orders(spark, sf_dir))


def dim_product(spark, sf_dir):
    return star.build_dim_product(S.products(spark, sf_dir), S.translation(spark, sf_dir))


def dim_product_merge(spark, sf_dir):
    """A first run over the small products, a second one over all with longer measures."""
    products, names = S.products(spark, sf_dir), S.translation(spark, sf_dir)
    first = star.build_dim_product(products.where("product_width_cm < 25"), names)
    longer = products.where("product_width_cm > 15").withColumn(
        "product_length_cm", F.col("product_length_cm") + 2
    )
    return star.build_dim_product(longer, names, existing=first)


def dim_customer_refresh(spark, sf_dir):
    """Known customers keep row and key although the second run brings another city."""
    customers = S.customers(spark, sf_dir)
    first = star.build_dim_customer(customers.where("customer_city <> 'BUILDING'"))
    moved = customers.withColumn("customer_city", F.lower("customer_city"))
    return star.build_dim_customer(moved, existing=first)


def dim_geolocation_refresh(spark, sf_dir):
    places = S.geolocations(spark, sf_dir)
    first = star.build_dim_geolocation(places.where("geolocation_city <> 'BUILDING'"))
    return star.build_dim_geolocation(places, existing=first)


def dim_time(spark, sf_dir):
    return star.build_dim_time_of(table(spark, sf_dir, "orders"), "o_orderdate")


def stable_keys(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    old = customers.where("c_acctbal < 0").select("c_custkey")
    first = assign_stable_keys(old, ["c_custkey"], "customer_key", key_type="long")
    return assign_stable_keys(
        customers, ["c_custkey"], "customer_key", existing=first, key_type="long"
    )


def _fact_inputs(spark, sf_dir):
    items = smallest_per_key(S.order_items_raw(spark, sf_dir), LINE_KEY)
    orders = S.source_orders(spark, sf_dir)
    builders = (dim_customer, dim_seller, dim_product, dim_order_status)
    dims = side_by_side(spark, {b.__name__: partial(b, spark, sf_dir) for b in builders})
    return items, orders, dims


def fact_order_item(spark, sf_dir):
    return star.build_fact_order_item(*_fact_inputs(spark, sf_dir))


def fact_unknown_member(spark, sf_dir):
    return star.build_fact_order_item(*_fact_inputs(spark, sf_dir), on_missing="unknown")


def fact_refresh(spark, sf_dir):
    """A first run over the lines of dear price, a second one over all lines. Both look the lines up in
    the same tables, which is done once."""
    lines = written(star.fact_lines(*_fact_inputs(spark, sf_dir)), "looked_up")
    first = star.number_lines(lines.where("item_price >= 30000"), stored=True)
    return star.number_lines(lines, existing=first)


def fact_rejects(spark, sf_dir):
    rejects = star.fact_rejects(*_fact_inputs(spark, sf_dir))
    return rejects.withColumn("missing_keys", F.concat_ws(",", "missing_keys"))


DIMENSION_SQL = {
    "dim_customer": """
        SELECT cast(row_number() OVER (ORDER BY customer_id) AS integer) AS customer_key, *
        FROM customers WHERE customer_unique_id IS NOT NULL
          AND customer_zip_code_prefix IS NOT NULL AND customer_city IS NOT NULL
          AND customer_state IS NOT NULL""",
    "dim_seller": """
        SELECT cast(row_number() OVER (ORDER BY seller_id) AS integer) AS seller_key, *
        FROM sellers WHERE seller_zip_code_prefix IS NOT NULL AND seller_city IS NOT NULL
          AND seller_state IS NOT NULL""",
    "dim_product": """
        SELECT cast(row_number() OVER (ORDER BY product_id) AS integer) AS product_key, *,
               product_length_cm * product_height_cm * product_width_cm AS product_volume_cm3,
               product_weight_g / (product_length_cm * product_height_cm * product_width_cm)
                   AS product_density_g_per_cm3
        FROM (SELECT product_id, product_category_name_english AS product_english_category_name,
                     product_category_name, product_weight_g, product_length_cm,
                     product_height_cm, product_width_cm
              FROM products JOIN translation USING (product_category_name)
              WHERE product_weight_g > 0 AND product_length_cm > 0 AND product_height_cm > 0
                AND product_width_cm > 0)""",
    "dim_order_status": """
        SELECT cast(row_number() OVER (ORDER BY order_status) AS integer) AS order_status_key,
               order_status
        FROM (SELECT DISTINCT order_status FROM source_orders)""",
    "dim_payment_type": """
        SELECT cast(row_number() OVER (ORDER BY payment_type) AS integer) AS payment_type_key,
               payment_type
        FROM (SELECT DISTINCT payment_type FROM order_payments)""",
    "dim_geolocation": """
        SELECT cast(row_number() OVER (
                   ORDER BY geolocation_zip_code_prefix, geolocation_city, geolocation_state,
                            geolocation_lat NULLS FIRST, geolocation_lng NULLS FIRST)
                   AS integer) AS geolocation_key, *
        FROM (SELECT DISTINCT * FROM geolocations WHERE geolocation_zip_code_prefix IS NOT NULL
                AND geolocation_city IS NOT NULL AND geolocation_state IS NOT NULL)""",
}

SOURCES = {
    "dim_customer": ("customers",),
    "dim_seller": ("sellers",),
    "dim_product": ("products", "translation"),
    "dim_order_status": ("source_orders",),
    "dim_payment_type": ("order_payments",),
    "dim_geolocation": ("geolocations",),
}


def _dimension(name: str) -> str:
    return with_tables(DIMENSION_SQL[name], *SOURCES[name])


_FACT_TABLES = with_tables(
    ", "
    + ", ".join(
        f"{n} AS ({DIMENSION_SQL[n]})"
        for n in ("dim_customer", "dim_seller", "dim_product", "dim_order_status")
    )
    + """, looked_up AS (
        SELECT i.order_id, i.order_item_id, p.product_key, c.customer_key, s.seller_key,
               t.order_status_key, cast(i.price AS decimal(12, 2)) AS item_price,
               cast(i.freight_value AS decimal(12, 2)) AS freight_value
        FROM order_items i
        LEFT JOIN source_orders o USING (order_id)
        LEFT JOIN dim_product p USING (product_id)
        LEFT JOIN dim_customer c USING (customer_id)
        LEFT JOIN dim_seller s USING (seller_id)
        LEFT JOIN dim_order_status t USING (order_status))""",
    "customers",
    "sellers",
    "products",
    "translation",
    "source_orders",
    "order_items_raw",
    "order_items",
)

CHECKS = {
    "translate_category": (
        translate_category,
        with_tables(
            " SELECT product_id, product_category_name_english, product_category_name"
            " FROM products JOIN translation USING (product_category_name)",
            "products",
            "translation",
        ),
    ),
    "lookup_key": (
        lookup_key,
        with_tables(
            f", dim AS ({DIMENSION_SQL['dim_seller']})"
            " SELECT order_id, order_item_id, product_id, seller_id, seller_key"
            " FROM order_items_raw JOIN dim USING (seller_id)",
            "sellers",
            "order_items_raw",
        ),
    ),
    "parent_child": (
        parent_child,
        with_tables(
            " SELECT o.order_id, o.order_status, i.* EXCLUDE (order_id) FROM source_orders o"
            " LEFT JOIN order_items_raw i USING (order_id)",
            "source_orders",
            "order_items_raw",
        ),
    ),
    "child_counts": (
        child_counts,
        with_tables(
            " SELECT customer_id, count(order_id) AS n_orders"
            " FROM customers LEFT JOIN source_orders USING (customer_id) GROUP BY ALL",
            "customers",
            "source_orders",
        ),
    ),
    "single_child": (
        single_child,
        "SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)",
    ),
    "dim_customer": (dim_customer, _dimension("dim_customer")),
    "dim_seller": (dim_seller, _dimension("dim_seller")),
    "dim_geolocation": (dim_geolocation, _dimension("dim_geolocation")),
    "dim_payment_type": (dim_payment_type, _dimension("dim_payment_type")),
    "dim_order_status": (dim_order_status, _dimension("dim_order_status")),
    "dim_product": (dim_product, _dimension("dim_product")),
    "dim_product_merge": (
        dim_product_merge,
        with_tables(
            """,
            named AS (SELECT product_id,
                             product_category_name_english AS product_english_category_name,
                             product_category_name, product_weight_g, product_length_cm,
                             product_height_cm, product_width_cm
                      FROM products JOIN translation USING (product_category_name)),
            first_run AS (SELECT row_number() OVER (ORDER BY product_id) AS k, * FROM named
                          WHERE product_width_cm < 25 AND product_weight_g > 0
                            AND product_length_cm > 0 AND product_height_cm > 0),
            longer AS (SELECT * REPLACE (product_length_cm + 2 AS product_length_cm) FROM named
                       WHERE product_width_cm > 15 AND product_weight_g > 0
                         AND product_length_cm + 2 > 0 AND product_height_cm > 0),
            merged AS (
                SELECT f.k AS product_key, f.product_id,
                       coalesce(l.product_english_category_name, f.product_english_category_name)
                           AS product_english_category_name,
                       coalesce(l.product_category_name, f.product_category_name)
                           AS product_category_name,
                       coalesce(l.product_weight_g, f.product_weight_g) AS product_weight_g,
                       coalesce(l.product_length_cm, f.product_length_cm) AS product_length_cm,
                       coalesce(l.product_height_cm, f.product_height_cm) AS product_height_cm,
                       coalesce(l.product_width_cm, f.product_width_cm) AS product_width_cm
                FROM first_run f LEFT JOIN longer l USING (product_id)
                UNION ALL
                SELECT (SELECT max(k) FROM first_run) + row_number() OVER (ORDER BY product_id), *
                FROM longer WHERE product_id NOT IN (SELECT product_id FROM first_run))
            SELECT * REPLACE (cast(product_key AS integer) AS product_key),
                   product_length_cm * product_height_cm * product_width_cm AS product_volume_cm3,
                   product_weight_g / (product_length_cm * product_height_cm * product_width_cm)
                       AS product_density_g_per_cm3
            FROM merged""",
            "products",
            "translation",
        ),
    ),
    "dim_customer_refresh": (
        dim_customer_refresh,
        with_tables(
            f""", first_run AS ({DIMENSION_SQL['dim_customer']} AND customer_city <> 'BUILDING')
            SELECT * FROM first_run
            UNION ALL
            SELECT cast((SELECT max(customer_key) FROM first_run)
                        + row_number() OVER (ORDER BY customer_id) AS integer),
                   customer_id, customer_unique_id, customer_zip_code_prefix,
                   lower(customer_city), customer_state
            FROM customers WHERE customer_state IS NOT NULL AND customer_city = 'BUILDING'""",
            "customers",
        ),
    ),
    "dim_geolocation_refresh": (
        dim_geolocation_refresh,
        with_tables(
            f""", all_places AS ({DIMENSION_SQL['dim_geolocation']}),
            first_run AS (SELECT * REPLACE (cast(row_number() OVER (ORDER BY geolocation_key)
                                                 AS integer) AS geolocation_key)
                          FROM all_places WHERE geolocation_city <> 'BUILDING')
            SELECT * FROM first_run
            UNION ALL
            SELECT * REPLACE (cast(geolocation_key + (SELECT max(geolocation_key) FROM first_run)
                                   AS integer) AS geolocation_key) FROM all_places""",
            "geolocations",
        ),
    ),
    "dim_time": (
        dim_time,
        """
        SELECT cast(year(d) * 10000 + month(d) * 100 + day(d) AS integer) AS date_id,
               d AS full_date, cast(isoyear(d) AS integer) AS year,
               cast(quarter(d) AS integer) AS quarter, cast(month(d) AS integer) AS month,
               cast(day(d) AS integer) AS day, cast(isodow(d) AS integer) AS day_of_week,
               dayname(d) AS day_name, cast(weekofyear(d) AS integer) AS week_of_year_iso,
               isodow(d) > 5 AS is_weekend
        FROM (SELECT cast(unnest(generate_series(
                  (SELECT date_trunc('day', min(o_orderdate)) FROM orders),
                  (SELECT date_trunc('day', max(o_orderdate)) FROM orders),
                  INTERVAL 1 DAY)) AS date) AS d)""",
    ),
    "stable_keys": (
        stable_keys,
        """
        WITH first_run AS (SELECT row_number() OVER (ORDER BY c_custkey) AS customer_key, c_custkey
                           FROM customer WHERE c_acctbal < 0)
        SELECT * FROM first_run
        UNION ALL
        SELECT (SELECT coalesce(max(customer_key), 0) FROM first_run)
               + row_number() OVER (ORDER BY c_custkey), c_custkey
        FROM customer WHERE c_acctbal >= 0""",
    ),
    "fact_order_item": (
        fact_order_item,
        _FACT_TABLES
        + """
        SELECT row_number() OVER (ORDER BY order_id, order_item_id) AS order_item_fact_key, *
        FROM looked_up WHERE product_key IS NOT NULL AND customer_key IS NOT NULL
          AND seller_key IS NOT NULL AND order_status_key IS NOT NULL""",
    ),
    "fact_refresh": (
        fact_refresh,
        _FACT_TABLES
        + """, kept AS (
            SELECT *, item_price >= 30000 AS early FROM looked_up
            WHERE product_key IS NOT NULL AND customer_key IS NOT NULL
              AND seller_key IS NOT NULL AND order_status_key IS NOT NULL)
        SELECT CASE WHEN early THEN 0 ELSE (SELECT count(*) FROM kept WHERE early) END
               + row_number() OVER (PARTITION BY early ORDER BY order_id, order_item_id)
                   AS order_item_fact_key, * EXCLUDE (early)
        FROM kept""",
    ),
    "fact_unknown_member": (
        fact_unknown_member,
        _FACT_TABLES
        + """
        SELECT row_number() OVER (ORDER BY order_id, order_item_id) AS order_item_fact_key,
               order_id, order_item_id, coalesce(product_key, -1) AS product_key,
               coalesce(customer_key, -1) AS customer_key, coalesce(seller_key, -1) AS seller_key,
               coalesce(order_status_key, -1) AS order_status_key, item_price, freight_value
        FROM looked_up""",
    ),
    "fact_rejects": (
        fact_rejects,
        _FACT_TABLES
        + """
        SELECT order_id, order_item_id,
               concat_ws(',', CASE WHEN product_key IS NULL THEN 'product_key' END,
                         CASE WHEN customer_key IS NULL THEN 'customer_key' END,
                         CASE WHEN seller_key IS NULL THEN 'seller_key' END,
                         CASE WHEN order_status_key IS NULL THEN 'order_status_key' END)
                   AS missing_keys
        FROM looked_up WHERE product_key IS NULL OR customer_key IS NULL OR seller_key IS NULL
             OR order_status_key IS NULL""",
    ),
}
