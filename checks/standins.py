"""The given tables in the shape of the retail source tables, as DataFrames and as SQL.

Every stand-in keeps all rows of its table. Missing values are put in where the retail tables
allow or must survive them, because the given tables hold none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SQL = {
    "customers": """
        SELECT cast(c_custkey AS varchar) AS customer_id, c_name AS customer_unique_id,
               cast(c_nationkey AS varchar) AS customer_zip_code_prefix,
               c_mktsegment AS customer_city,
               nullif(cast(c_nationkey AS varchar), '7') AS customer_state
        FROM customer""",
    "sellers": """
        SELECT cast(s_suppkey AS varchar) AS seller_id,
               nullif(cast(s_nationkey AS varchar), '3') AS seller_zip_code_prefix,
               s_name AS seller_city, cast(s_nationkey AS varchar) AS seller_state
        FROM supplier""",
    "geolocations": """
        SELECT cast(c_nationkey AS varchar) AS geolocation_zip_code_prefix,
               c_mktsegment AS geolocation_city,
               nullif(cast(c_nationkey AS varchar), '7') AS geolocation_state,
               cast(nullif(c_nationkey, 5) AS double) / 4 AS geolocation_lat,
               cast(length(c_mktsegment) AS double) AS geolocation_lng
        FROM customer""",
    "products": """
        SELECT cast(p_partkey AS varchar) AS product_id, p_type AS product_category_name,
               cast(trunc(p_retailprice) AS integer) AS product_weight_g,
               p_size - 3 AS product_length_cm, nullif(p_size, 7) AS product_height_cm,
               p_size + 1 AS product_width_cm
        FROM part""",
    "translation": """
        SELECT DISTINCT p_type AS product_category_name,
               lower(p_type) AS product_category_name_english
        FROM part WHERE p_type <> 'PROMO'""",
    "source_orders": """
        SELECT cast(o_orderkey AS varchar) AS order_id, cast(o_custkey AS varchar) AS customer_id,
               o_orderstatus AS order_status, o_orderdate AS order_purchase_timestamp
        FROM orders""",
    "order_items_raw": """
        SELECT cast(l_orderkey AS varchar) AS order_id, l_linenumber AS order_item_id,
               cast(l_partkey AS varchar) AS product_id, cast(l_suppkey AS varchar) AS seller_id,
               l_shipdate AS shipping_limit_date, l_extendedprice AS price, l_tax AS freight_value
        FROM lineitem""",
    "order_items": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY order_id, order_item_id
                ORDER BY product_id, seller_id, shipping_limit_date, price, freight_value) AS rn
            FROM order_items_raw) WHERE rn = 1""",
    "order_payments": """
        SELECT cast(o_orderkey AS varchar) AS order_id, o_orderpriority AS payment_type,
               o_totalprice AS payment_value
        FROM orders""",
    "reviews": """
        SELECT cast(doc_id AS varchar) AS review_id, cast(doc_id AS varchar) AS order_id,
               nullif(source, 'src3') || chr(9) || lang AS review_comment_title,
               text || chr(13) || chr(10) || source AS review_comment_message
        FROM documents""",
    "changes": """
        SELECT user_id, event_id AS seq, ts, value,
               CASE event_type WHEN 'signup' THEN 'create' WHEN 'error' THEN 'delete'
                               ELSE 'update' END AS op
        FROM events""",
}


def with_tables(query: str, *names: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({SQL[n]})" for n in names) + query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(name: str):
    return F.col(name).cast("string")


def customers(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        text("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        text("c_nationkey").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.nullif(text("c_nationkey"), F.lit("7")).alias("customer_state"),
    )


def sellers(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        text("s_suppkey").alias("seller_id"),
        F.nullif(text("s_nationkey"), F.lit("3")).alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        text("s_nationkey").alias("seller_state"),
    )


def geolocations(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        text("c_nationkey").alias("geolocation_zip_code_prefix"),
        F.col("c_mktsegment").alias("geolocation_city"),
        F.nullif(text("c_nationkey"), F.lit("7")).alias("geolocation_state"),
        (F.nullif(F.col("c_nationkey"), F.lit(5)).cast("double") / 4).alias("geolocation_lat"),
        F.length("c_mktsegment").cast("double").alias("geolocation_lng"),
    )


def products(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        text("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        F.col("p_retailprice").cast("int").alias("product_weight_g"),
        (F.col("p_size") - 3).alias("product_length_cm"),
        F.nullif(F.col("p_size"), F.lit(7)).alias("product_height_cm"),
        (F.col("p_size") + 1).alias("product_width_cm"),
    )


def translation(spark, sf_dir) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .where("p_type <> 'PROMO'")
        .select(
            F.col("p_type").alias("product_category_name"),
            F.lower("p_type").alias("product_category_name_english"),
        )
        .distinct()
    )


def source_orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("order_id"),
        text("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
    )


def order_items_raw(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        text("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        text("l_partkey").alias("product_id"),
        text("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_tax").alias("freight_value"),
    )


def order_payments(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("order_id"),
        F.col("o_orderpriority").alias("payment_type"),
        F.col("o_totalprice").alias("payment_value"),
    )


def reviews(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        text("doc_id").alias("review_id"),
        text("doc_id").alias("order_id"),
        F.concat(F.nullif("source", F.lit("src3")), F.lit("\t"), "lang").alias(
            "review_comment_title"
        ),
        F.concat("text", F.lit("\r\n"), "source").alias("review_comment_message"),
    )


def changes(spark, sf_dir) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "user_id",
        F.col("event_id").alias("seq"),
        "ts",
        "value",
        F.when(kind == "signup", "create").when(kind == "error", "delete").otherwise("update")
        .alias("op"),
    )
