"""Queries for scans, casts, filters and text cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import standins as S
from checks.standins import table, with_tables
from martloom.functions import casts
from martloom.functions.text import clean_controls, truncate_text
from martloom.operators import rows as R
from martloom.plans.ingest import ingest, type_table
from martloom.shared import fresh_path
from martloom.sources.files import INPUT_ORDER, read_csv_text
from martloom.specs import DOUBLE, LONG, SOURCE_TABLES, TEXT, TIME, TableSpec

ORDERS_FILE = TableSpec(
    "orders",
    dict(
        o_orderkey=LONG,
        o_custkey=LONG,
        o_orderstatus=TEXT,
        o_totalprice=DOUBLE,
        o_orderdate=TIME,
        o_orderpriority=TEXT,
    ),
    key=("o_orderkey",),
)

DOCUMENTS_FILE = TableSpec(
    "documents",
    dict(doc_id=LONG, text=TEXT, lang=TEXT, source=TEXT, n_chars=LONG),
    key=("doc_id",),
    free_text=("text",),
)


EVENTS_FILE = TableSpec(
    "events",
    dict(event_id=LONG, ts=TIME, user_id=LONG, event_type=TEXT, value=DOUBLE, props=TEXT),
    key=("user_id",),
)


def _csv_copy(df, spec):
    path = fresh_path(df.sparkSession, f"csv-{spec.name}")
    (
        df.select(*spec.columns)
        .write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )
    return path


def csv_typed_scan(spark, sf_dir):
    path = _csv_copy(table(spark, sf_dir, "orders"), ORDERS_FILE)
    return type_table(read_csv_text(spark, path, ORDERS_FILE), ORDERS_FILE)


def csv_free_text_scan(spark, sf_dir):
    path = _csv_copy(table(spark, sf_dir, "documents"), DOCUMENTS_FILE)
    return type_table(read_csv_text(spark, path, DOCUMENTS_FILE), DOCUMENTS_FILE)


def dedup_first_in_files(spark, sf_dir):
    """The first event of each user in input order, over files written in event order."""
    events = table(spark, sf_dir, "events").repartitionByRange("event_id")
    path = _csv_copy(events.sortWithinPartitions("event_id"), EVENTS_FILE)
    raw = read_csv_text(spark, path, EVENTS_FILE, keep_order=True)
    first = R.dedup_first(type_table(raw, EVENTS_FILE), ["user_id"], [INPUT_ORDER])
    return first.drop(INPUT_ORDER)


def _ingested(spark, sf_dir):
    """Products, translation and order lines as CSV, then typed and pruned together."""
    names = ("product_name_length", "product_description_length", "product_photos_qty")
    products = S.products(spark, sf_dir).withColumns(
        {c: F.length("product_category_name").cast("double") for c in names}
    )
    frames = {
        "products": products,
        "product_category_name_translation": S.translation(spark, sf_dir),
        "order_items": S.order_items_raw(spark, sf_dir),
    }
    return ingest(
        spark, {name: _csv_copy(df, SOURCE_TABLES[name]) for name, df in frames.items()}
    )


def ingest_order_items(spark, sf_dir):
    return _ingested(spark, sf_dir)["order_items"]


def ingest_products(spark, sf_dir):
    """Lengths given as `5.0` are read as whole numbers."""
    return _ingested(spark, sf_dir)["products"]


def ingest_reviews(spark, sf_dir):
    """Every document twice under one review id: the first in the file stays, line breaks and all."""
    docs = table(spark, sf_dir, "documents")
    reviews = docs.select(
        S.text("doc_id").alias("review_id"),
        F.col("source").alias("order_id"),
        (F.col("doc_id") % 5 + 1).cast("int").alias("review_score"),
        F.col("lang").alias("review_comment_title"),
        F.col("text").alias("review_comment_message"),
        F.lit("2018-01-01 10:00:00").cast("timestamp_ntz").alias("review_creation_date"),
        F.lit(None).cast("timestamp_ntz").alias("review_answer_timestamp"),
    )
    again = F.explode(F.array(F.lit(0), F.lit(1)))
    twice = reviews.withColumn("_nth", again).withColumn(
        "review_score", F.col("review_score") + 5 * F.col("_nth")
    )
    ordered = twice.repartitionByRange("review_id").sortWithinPartitions("review_id", "_nth")
    spec = SOURCE_TABLES["order_reviews"]
    return ingest(spark, {"order_reviews": _csv_copy(ordered, spec)})["order_reviews"]


def ingest_geolocations(spark, sf_dir):
    """One row per point, the first in the file; points as text with and without a last zero, a
    missing latitude like any other."""
    shown = F.concat(
        F.format_string("%.2f", "geolocation_lat"),
        F.when(F.col("geolocation_city") > "F", "0").otherwise(""),
    )
    places = S.geolocations(spark, sf_dir).withColumns(
        {
            "geolocation_state": F.coalesce("geolocation_state", F.lit("none")),
            "_text": F.when(F.col("geolocation_lat").isNotNull(), shown),
        }
    )
    order = ["geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"]
    sorted_ = places.repartitionByRange(*order).sortWithinPartitions(*order)
    path = _csv_copy(
        sorted_.withColumn("geolocation_lat", F.col("_text")), SOURCE_TABLES["geolocations"]
    )
    return ingest(spark, {"geolocations": path})["geolocations"]


def null_markers(spark, sf_dir):
    p = F.col("o_orderpriority")
    marked = (
        F.when(p == "1-URGENT", "NA").when(p == "2-HIGH", "null").when(p == "3-MEDIUM", "")
        .otherwise(p)
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", marked.alias("priority"))
    return R.null_markers(orders)


def strict_numbers(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        casts.strict_int(S.text("l_quantity")).alias("quantity"),
        casts.strict_double(S.text("l_extendedprice")).alias("price"),
        casts.strict_int(S.text("l_partkey"), "bigint").alias("part"),
        casts.strict_int(
            F.when(F.col("l_linenumber") == 1, "9223372036854775807")
            .when(F.col("l_linenumber") == 2, "-9223372036854775808")
            .when(F.col("l_linenumber") == 3, "0000000000000000000000007")
            .when(F.col("l_linenumber") == 4, "9007199254740993")
            .otherwise(F.concat(S.text("l_partkey"), F.lit(".75"))),
            "bigint",
        ).alias("edge"),
    )


def lenient_numbers(spark, sf_dir):
    size, kind = S.text("p_size"), F.col("p_type")
    given = (
        F.when(kind == "PROMO", F.concat(size, F.lit("x")))
        .when(kind == "SMALL", "NaN")
        .when(kind == "LARGE", F.concat(size, F.lit(".9")))
        .otherwise(size)
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        casts.lenient_int(given).alias("size"),
        casts.lenient_double(given).alias("size_number"),
    )


def lenient_timestamps(spark, sf_dir):
    kind, ts = F.col("event_type"), F.col("ts")
    given = (
        F.when(kind == "error", "junk")
        .when(kind == "view", F.date_format(ts, "yyyy-MM-dd"))
        .when(kind == "click", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
    )
    later = F.concat(
        (F.year(ts) + 300).cast("string"), F.date_format(ts, "-MM-'01' HH:mm:ss")
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        casts.lenient_timestamp(given).alias("ts"),
        casts.lenient_timestamp(F.date_format(ts, "yyyy-MM-dd"), "yyyy-MM-dd").alias("day"),
        casts.lenient_timestamp(F.date_format(ts, "dd/MM/yyyy HH:mm"), "dd/MM/yyyy HH:mm")
        .alias("minute"),
        casts.lenient_timestamp(later).alias("later"),
    )


def missing_to_null(spark, sf_dir):
    given = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment")).alias(
            "segment"
        ),
        F.when(F.col("c_acctbal") < 0, float("nan")).otherwise(F.col("c_acctbal")).alias("balance"),
    )
    return R.nan_values_to_null(R.empty_text_to_null(given, ["segment"]), ["balance"])


def project(spark, sf_dir):
    spec = TableSpec("lines", dict(l_linenumber=LONG, l_orderkey=LONG, l_tax=DOUBLE), key=())
    return R.project(table(spark, sf_dir, "lineitem"), spec)


def _orders_with_gaps(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
    )


def not_null_filter(spark, sf_dir):
    return R.require_not_null(_orders_with_gaps(spark, sf_dir), ["status", "priority"])


def positive_filter(spark, sf_dir):
    return R.require_positive(
        S.products(spark, sf_dir), ["product_length_cm", "product_height_cm"]
    )


def text_filter(spark, sf_dir):
    source = F.nullif("source", F.lit("src1"))
    given = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(source == "src2", "").otherwise(source).alias("source")
    )
    return R.require_text(given, "source")


def known_category(spark, sf_dir):
    return R.keep_known(
        S.products(spark, sf_dir), S.translation(spark, sf_dir), ["product_category_name"]
    )


def cascade_prune(spark, sf_dir):
    return R.cascade_prune(
        S.order_items_raw(spark, sf_dir),
        S.products(spark, sf_dir),
        S.translation(spark, sf_dir),
    )


def distinct_rows(spark, sf_dir):
    return R.distinct_rows(table(spark, sf_dir, "documents"), ["lang", "source"])


def dedup_first(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    return R.dedup_first(lines, keys, [c for c in lines.columns if c not in keys])


def clean_text(spark, sf_dir):
    return S.reviews(spark, sf_dir).select(
        "review_id",
        clean_controls(F.col("review_comment_title")).alias("title"),
        clean_controls(F.col("review_comment_message")).alias("message"),
    )


def truncate(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", truncate_text(F.col("text")).alias("text")
    )


def money_cast(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        casts.money(F.col("l_extendedprice")).alias("item_price"),
        casts.money(F.col("l_tax")).alias("freight_value"),
    )


_CLEAN = "replace(replace(replace({0}, chr(9), ' '), chr(10), ' '), chr(13), ' ')"

CHECKS = {
    "csv_typed_scan": (
        csv_typed_scan,
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
        " FROM orders",
    ),
    "csv_free_text_scan": (csv_free_text_scan, "SELECT doc_id, text, lang, source, n_chars FROM documents"),
    "dedup_first_in_files": (
        dedup_first_in_files,
        """
        SELECT event_id, date_trunc('second', ts) AS ts, user_id, event_type, value, props FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn
            FROM events) WHERE rn = 1""",
    ),
    "ingest_order_items": (
        ingest_order_items,
        with_tables(
            " SELECT * FROM order_items_raw WHERE product_id IN (SELECT product_id FROM products"
            " WHERE product_category_name IN (SELECT product_category_name FROM translation))",
            "products",
            "translation",
            "order_items_raw",
        ),
    ),
    "ingest_products": (
        ingest_products,
        with_tables(
            " SELECT product_id, product_category_name, length(product_category_name)::INTEGER"
            " AS product_name_length, length(product_category_name)::INTEGER AS"
            " product_description_length, length(product_category_name)::INTEGER AS"
            " product_photos_qty, product_weight_g, product_length_cm, product_height_cm,"
            " product_width_cm FROM products WHERE product_category_name IN"
            " (SELECT product_category_name FROM translation)",
            "products",
            "translation",
        ),
    ),
    "ingest_reviews": (
        ingest_reviews,
        "SELECT cast(doc_id AS varchar) AS review_id, source AS order_id,"
        " (doc_id % 5 + 1)::INTEGER AS review_score, lang AS review_comment_title,"
        " text AS review_comment_message,"
        " TIMESTAMP '2018-01-01 10:00:00' AS review_creation_date,"
        " NULL::TIMESTAMP AS review_answer_timestamp FROM documents",
    ),
    "ingest_geolocations": (
        ingest_geolocations,
        with_tables(
            """
            SELECT geolocation_zip_code_prefix, geolocation_lat, geolocation_lng, geolocation_city,
                   coalesce(geolocation_state, 'none') AS geolocation_state
            FROM (SELECT *, row_number() OVER (
                      PARTITION BY geolocation_lat, geolocation_lng
                      ORDER BY geolocation_zip_code_prefix, geolocation_city) AS rn
                  FROM geolocations) WHERE rn = 1""",
            "geolocations",
        ),
    ),
    "null_markers": (
        null_markers,
        "SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"
        " THEN NULL ELSE o_orderpriority END AS priority FROM orders",
    ),
    "strict_numbers": (
        strict_numbers,
        "SELECT l_orderkey, l_linenumber, cast(trunc(l_quantity) AS integer) AS quantity,"
        " l_extendedprice AS price, l_partkey AS part, CASE l_linenumber"
        " WHEN 1 THEN 9223372036854775807 WHEN 2 THEN -9223372036854775808 WHEN 3 THEN 7"
        " WHEN 4 THEN 9007199254740993 ELSE l_partkey END::BIGINT AS edge FROM lineitem",
    ),
    "lenient_numbers": (
        lenient_numbers,
        """
        SELECT p_partkey,
               CASE WHEN p_type IN ('PROMO', 'SMALL') THEN NULL ELSE p_size END AS size,
               CASE WHEN p_type IN ('PROMO', 'SMALL') THEN NULL
                    WHEN p_type = 'LARGE' THEN cast(p_size || '.9' AS double)
                    ELSE cast(p_size AS double) END AS size_number
        FROM part""",
    ),
    "lenient_timestamps": (
        lenient_timestamps,
        "SELECT event_id, CASE WHEN event_type IN ('error', 'view', 'click') THEN NULL"
        " ELSE date_trunc('second', ts) END AS ts, cast(date_trunc('day', ts) AS timestamp) AS day,"
        " date_trunc('minute', ts) AS minute, date_trunc('month', ts) + INTERVAL 300 YEAR"
        " + (date_trunc('second', ts) - date_trunc('day', ts)) AS later FROM events",
    ),
    "missing_to_null": (
        missing_to_null,
        "SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment,"
        " CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance FROM customer",
    ),
    "project": (project, "SELECT l_linenumber, l_orderkey, l_tax FROM lineitem"),
    "not_null_filter": (
        not_null_filter,
        "SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority FROM orders"
        " WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'",
    ),
    "positive_filter": (
        positive_filter,
        with_tables(
            " SELECT * FROM products WHERE product_length_cm > 0 AND product_height_cm > 0",
            "products",
        ),
    ),
    "text_filter": (
        text_filter,
        "SELECT doc_id, source FROM documents WHERE source NOT IN ('src1', 'src2')",
    ),
    "known_category": (
        known_category,
        with_tables(
            " SELECT * FROM products WHERE product_category_name IN"
            " (SELECT product_category_name FROM translation)",
            "products",
            "translation",
        ),
    ),
    "cascade_prune": (
        cascade_prune,
        with_tables(
            " SELECT * FROM order_items_raw WHERE product_id IN (SELECT product_id FROM products"
            " WHERE product_category_name <> '' AND product_category_name IN"
            " (SELECT product_category_name FROM translation))",
            "products",
            "translation",
            "order_items_raw",
        ),
    ),
    "distinct_rows": (distinct_rows, "SELECT DISTINCT lang, source FROM documents"),
    "dedup_first": (
        dedup_first,
        """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                         l_returnflag, l_linestatus, l_shipdate) AS rn
            FROM lineitem) WHERE rn = 1""",
    ),
    "clean_text": (
        clean_text,
        with_tables(
            f" SELECT review_id, {_CLEAN.format('review_comment_title')} AS title,"
            f" {_CLEAN.format('review_comment_message')} AS message FROM reviews",
            "reviews",
        ),
    ),
    "truncate_text": (truncate, "SELECT doc_id, left(text, 255) AS text FROM documents"),
    "money_cast": (
        money_cast,
        "SELECT l_orderkey, l_linenumber, cast(l_extendedprice AS decimal(12, 2)) AS item_price,"
        " cast(l_tax AS decimal(12, 2)) AS freight_value FROM lineitem",
    ),
}
