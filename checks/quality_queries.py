"""Queries for the table checks."""

from __future__ import annotations

from checks import standins as S
from checks.standins import table, with_tables
from martloom.operators import quality as Q
from martloom.specs import DOUBLE, INT, TEXT, Reference, TableSpec

ITEMS = TableSpec(
    "order_items",
    dict(
        order_id=TEXT,
        order_item_id=INT,
        product_id=TEXT,
        seller_id=TEXT,
        price=DOUBLE,
        freight_value=DOUBLE,
    ),
    key=("order_id", "order_item_id"),
    references=(
        Reference(("product_id",), "products", ("product_id",)),
        Reference(("seller_id",), "sellers", ("seller_id",)),
    ),
    limits=dict(product_id=3),
)


def key_violations(spark, sf_dir):
    return Q.key_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def fk_orphans(spark, sf_dir):
    large = table(spark, sf_dir, "part").where("p_size > 10")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return Q.fk_orphans(lines, large, {"l_partkey": "p_partkey"})


def null_violations(spark, sf_dir):
    return Q.null_violations(
        S.geolocations(spark, sf_dir),
        ["geolocation_city", "geolocation_state", "geolocation_lat"],
    )


def length_violations(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return Q.length_violations(docs, {"text": 255, "source": 4, "lang": 8}, ["doc_id"])


def byte_length_violations(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return Q.length_violations(docs, {"text": 255}, ["doc_id"], unit="bytes")


def check_table(spark, sf_dir):
    products = S.products(spark, sf_dir).where("product_length_cm > 0")
    parents = {"products": products, "sellers": S.sellers(spark, sf_dir)}
    return Q.check_table(S.order_items_raw(spark, sf_dir), ITEMS, parents)


CHECKS = {
    "key_violations": (
        key_violations,
        "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem"
        " GROUP BY ALL HAVING count(*) > 1",
    ),
    "fk_orphans": (
        fk_orphans,
        "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey NOT IN"
        " (SELECT p_partkey FROM part WHERE p_size > 10)",
    ),
    "null_violations": (
        null_violations,
        with_tables(
            """
            SELECT 'geolocation_city' AS column_name,
                   count(*) FILTER (geolocation_city IS NULL) AS n_nulls FROM geolocations
            UNION ALL
            SELECT 'geolocation_state', count(*) FILTER (geolocation_state IS NULL)
            FROM geolocations
            UNION ALL
            SELECT 'geolocation_lat', count(*) FILTER (geolocation_lat IS NULL)
            FROM geolocations""",
            "geolocations",
        ),
    ),
    "length_violations": (
        length_violations,
        """
        SELECT doc_id, 'text' AS column_name, cast(length(text) AS integer) AS found_length,
               255 AS max_length FROM documents WHERE length(text) > 255
        UNION ALL
        SELECT doc_id, 'source', cast(length(source) AS integer), 4
        FROM documents WHERE length(source) > 4
        UNION ALL
        SELECT doc_id, 'lang', cast(length(lang) AS integer), 8
        FROM documents WHERE length(lang) > 8""",
    ),
    "byte_length_violations": (
        byte_length_violations,
        "SELECT doc_id, 'text' AS column_name, cast(strlen(text) AS integer) AS found_length,"
        " 255 AS max_length FROM documents WHERE strlen(text) > 255",
    ),
    "check_table": (
        check_table,
        with_tables(
            """,
            wide AS (SELECT count(*) FILTER (length(order_id) > 255) AS l1,
                            count(*) FILTER (length(product_id) > 3) AS l2,
                            count(*) FILTER (length(seller_id) > 255) AS l3 FROM order_items_raw)
            SELECT 'order_items' AS table_name, 'not_null' AS check_name, c AS subject,
                   cast(0 AS bigint) AS n_violations
            FROM (SELECT unnest(['order_id', 'order_item_id', 'product_id', 'seller_id', 'price',
                                 'freight_value']) AS c)
            UNION ALL SELECT 'order_items', 'length', 'order_id', l1 FROM wide
            UNION ALL SELECT 'order_items', 'length', 'product_id', l2 FROM wide
            UNION ALL SELECT 'order_items', 'length', 'seller_id', l3 FROM wide
            UNION ALL SELECT 'order_items', 'key', 'order_id,order_item_id', count(*)
            FROM (SELECT order_id, order_item_id FROM order_items_raw
                  GROUP BY ALL HAVING count(*) > 1)
            UNION ALL SELECT 'order_items', 'reference', 'products', count(*)
            FROM order_items_raw WHERE product_id NOT IN
                 (SELECT product_id FROM products WHERE product_length_cm > 0)
            UNION ALL SELECT 'order_items', 'reference', 'sellers', count(*)
            FROM order_items_raw WHERE seller_id NOT IN (SELECT seller_id FROM sellers)""",
            "products",
            "sellers",
            "order_items_raw",
        ),
    ),
}
