"""Queries for merges, staging tables, loads and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import standins as S
from checks.standins import table, with_tables
from martloom.operators import merge as M
from martloom.operators.rows import keep_latest as latest
from martloom.operators.rows import smallest_per_key
from martloom.shared import fresh_path, remove_folder, written
from martloom.sinks.layout import bucket_count, input_bytes, save_hashed
from martloom.sinks.loads import load_all, run_copies
from martloom.sinks.staging import StagingTable, arrived
from martloom.sources.changes import SEQ_FIELD
from martloom.specs import DOUBLE, INT, LONG, TEXT, TIME, Reference, TableSpec
from martloom.streaming.upsert import (
    stream_changes,
    stream_clean,
    stream_published,
    stream_upsert,
)

PRODUCTS = TableSpec(
    "products",
    dict(product_id=TEXT, product_category_name=TEXT, product_length_cm=INT),
    key=("product_id",),
    references=(
        Reference(("product_category_name",), "translation", ("product_category_name",)),
    ),
)
TRANSLATION = TableSpec(
    "translation",
    dict(product_category_name=TEXT, product_category_name_english=TEXT),
    key=("product_category_name",),
)
REVIEWS = TableSpec(
    "reviews",
    dict(review_id=TEXT, order_id=TEXT, review_comment_title=TEXT, review_comment_message=TEXT),
    key=("review_id",),
    free_text=("review_comment_title", "review_comment_message"),
)
USER_VALUES = TableSpec("user_state", dict(user_id=LONG, ts=TIME, value=DOUBLE), key=("user_id",))
# Micro-batches that a stream query runs through, at any size of its input.
MICRO_BATCHES = 4
USER_STATE = TableSpec(
    "user_state", dict(user_id=LONG, seq=LONG, ts=TIME, value=DOUBLE), key=("user_id",)
)


def _parts(spark, sf_dir):
    return S.products(spark, sf_dir).select(*PRODUCTS.columns)


def insert_if_absent(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    target = parts.where("product_length_cm < 20")
    changed = parts.withColumn("product_length_cm", F.col("product_length_cm") + 100)
    return M.insert_if_absent(target, changed, ["product_id"])


def new_rows(spark, sf_dir):
    """Order lines by product: the smallest new line per product not yet in the target."""
    lines = S.order_items_raw(spark, sf_dir).select("product_id", "order_id", "order_item_id")
    target = _parts(spark, sf_dir).where("product_length_cm < 20")
    return M.new_rows(target, lines, ["product_id"])


def upsert(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    target = parts.where("product_length_cm < 30").withColumn("note", F.lit("kept"))
    batch = parts.where("product_length_cm > 10").withColumns(
        {
            "product_length_cm": F.col("product_length_cm") + 100,
            "product_category_name": F.lower("product_category_name"),
        }
    )
    return M.upsert(target, batch, ["product_id"], ["product_length_cm"])


def append_distinct(spark, sf_dir):
    places = S.geolocations(spark, sf_dir)
    return M.append_distinct(M.append_distinct(places.where("1 = 0"), places), places)


def keep_latest(spark, sf_dir):
    return latest(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])


def apply_changes(spark, sf_dir):
    """Customers as the state before, user events as its changes."""
    target = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("value")
    )
    return M.apply_changes(target, S.changes(spark, sf_dir), ["user_id"], ["ts", "seq"], "op")


def _staged_lines(spark, sf_dir, buckets=None):
    """An empty staging table of the last line per product, early lines and late ones."""
    lines = S.order_items_raw(spark, sf_dir).select(
        "product_id", "seller_id", "shipping_limit_date", "price"
    )
    target = StagingTable(
        fresh_path(spark, "staging"), lines.schema, ("product_id",),
        ("shipping_limit_date", "price", "seller_id"), buckets,
    )
    target.create_if_absent(spark)
    early = F.coalesce(F.col("price") >= 30000, F.lit(False))
    return target, lines.where(early), lines.where(~early)


def staging_upsert(spark, sf_dir):
    target, early, late = _staged_lines(spark, sf_dir)
    target.upsert(early)
    target.upsert(late)
    return target.current(spark)


def staging_upsert_compacted(spark, sf_dir):
    """The early lines' products are deleted and the tombstones forgotten before all lines come."""
    target, early, late = _staged_lines(spark, sf_dir)
    target.upsert(early)
    target.upsert(target.current(spark).withColumn("_deleted", F.lit(True)))
    target.forget_deleted(spark)
    target.upsert(early.unionByName(late))
    return target.current(spark)


def staging_upsert_hashed(spark, sf_dir):
    buckets = bucket_count(table(spark, sf_dir, "lineitem"))
    target, early, late = _staged_lines(spark, sf_dir, buckets)
    target.upsert(early)
    target.upsert(late)
    return target.current(spark)


def staging_retry_after_compact(spark, sf_dir):
    """A write that was lost halfway, so that some buckets lack it, is tried again after a later one:
    no row is lost, none is older than before."""
    target, early, late = _staged_lines(spark, sf_dir)
    late = arrived(late)
    halfway = F.pmod(F.xxhash64("product_id"), F.lit(2)) == 0
    target.upsert(late.where(halfway))
    target.upsert(early)
    target.forget_deleted(spark)
    target.upsert(late)
    target.upsert(late)
    return target.current(spark)


def ordered_load(spark, sf_dir):
    """Full refresh of two tables, parents first; then both are read back and joined."""
    target = fresh_path(spark, "load")
    frames = {"products": _parts(spark, sf_dir), "translation": S.translation(spark, sf_dir)}
    specs = {"products": PRODUCTS, "translation": TRANSLATION}
    load_all(frames, target, specs)
    load_all(frames, target, specs)
    products = spark.read.parquet(f"{target}/products")
    return products.join(
        spark.read.parquet(f"{target}/translation"), "product_category_name", "left"
    )


def copy_jobs(spark, sf_dir):
    """Four copies, one of which fails because its key column is missing."""
    frames = {
        "products": _parts(spark, sf_dir).drop("product_category_name"),
        "translation": S.translation(spark, sf_dir),
        "reviews": S.reviews(spark, sf_dir),
        "user_state": S.changes(spark, sf_dir),
    }
    specs = {s.name: s for s in (PRODUCTS, TRANSLATION, REVIEWS, USER_STATE)}
    report = run_copies(
        spark, lambda spec: frames[spec.name], fresh_path(spark, "copies"), specs=specs,
        order={"user_state": ("seq",)},
    )
    return report.select(
        "table_name", "status", "n_rows",
        F.col("error").contains("product_category_name").alias("names_column"),
    )


def copy_jobs_hashed(spark, sf_dir):
    """Two copies, hash-distributed by key, read back and joined."""
    frames = {"products": _parts(spark, sf_dir), "translation": S.translation(spark, sf_dir)}
    specs = {s.name: s for s in (PRODUCTS, TRANSLATION)}
    target = fresh_path(spark, "copies")
    buckets = bucket_count(frames["products"])
    run_copies(spark, lambda s: frames[s.name], target, specs=specs, buckets=buckets)
    products, names = (StagingTable.of(f"{target}/{n}", specs[n]).current(spark) for n in specs)
    return products.join(names, "product_category_name", "left")


def staged_reviews(spark, sf_dir):
    """The reviews as the copy job leaves them in staging."""
    target = fresh_path(spark, "copies")
    run_copies(spark, lambda spec: S.reviews(spark, sf_dir), target, specs={"reviews": REVIEWS})
    return StagingTable.of(f"{target}/reviews", REVIEWS).current(spark)


def raw_reviews(spark, sf_dir):
    """The reviews copied without cleaning."""
    target = fresh_path(spark, "copies")
    run_copies(
        spark, lambda spec: S.reviews(spark, sf_dir), target, specs={"reviews": REVIEWS},
        raw=["reviews"],
    )
    return StagingTable.of(f"{target}/reviews", REVIEWS).current(spark)


def hash_layout(spark, sf_dir):
    """Lines and their amounts, each hash-distributed by line key, joined without a shuffle."""
    keys = ["order_id", "order_item_id"]
    lines = written(smallest_per_key(S.order_items_raw(spark, sf_dir), keys), "lines")
    buckets = bucket_count(lines)
    saved = []
    for cols in (["product_id", "seller_id"], ["price", "freight_value"]):
        path = fresh_path(spark, "hashed")
        name = "hashed_" + path.rpartition("-")[2]
        saved.append(save_hashed(lines.select(*keys, *cols), name, keys, buckets, path))
    return saved[0].join(saved[1], keys)


def _arriving(df, name):
    """Change files as they would arrive, `<folder>/<name>`, some for each micro-batch, and the bytes
    that a micro-batch takes."""
    folder = fresh_path(df.sparkSession, "arriving")
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(max(2 * MICRO_BATCHES, tasks)).write.parquet(f"{folder}/{name}")
    written_bytes = input_bytes(df.sparkSession.read.parquet(f"{folder}/{name}"))
    return folder, max(1, written_bytes // MICRO_BATCHES)


def _user_changes(spark, sf_dir):
    changes = S.changes(spark, sf_dir).select("op", "seq", "user_id", "ts", "value")
    return _arriving(changes, "user_state")


def stream_upsert_query(spark, sf_dir):
    """Every change counts as a new state, deletes too."""
    folder, size = _user_changes(spark, sf_dir)
    stream = stream_changes(
        spark, USER_VALUES, f"{folder}/user_state", max_bytes_per_trigger=size
    )
    target = StagingTable.of(fresh_path(spark, "staging"), USER_STATE, seq=("seq",))
    stream_upsert(
        stream.select(*USER_STATE.columns), target, fresh_path(spark, "checkpoint"), True
    ).awaitTermination()
    return target.current(spark)


def stream_new_checkpoint(spark, sf_dir):
    """A second stream starts with a fresh checkpoint at the place of the first and sees all rows;
    the first saw half of them."""
    changes = S.changes(spark, sf_dir)
    target = StagingTable.of(fresh_path(spark, "staging"), USER_STATE, seq=("seq",))
    checkpoint = fresh_path(spark, "checkpoint")
    for part in (changes.where("user_id % 2 = 0"), changes):
        folder, size = _arriving(part.select("op", "seq", "user_id", "ts", "value"), "user_state")
        stream = stream_changes(
            spark, USER_VALUES, f"{folder}/user_state", max_bytes_per_trigger=size
        )
        stream_upsert(
            stream.select(*USER_STATE.columns), target, checkpoint, True
        ).awaitTermination()
        remove_folder(spark, checkpoint)
    return target.current(spark)


def stream_apply_changes_query(spark, sf_dir):
    """The published change stream of one table, from arriving files to the merged rows."""
    target = fresh_path(spark, "staging")
    folder, size = _user_changes(spark, sf_dir)
    for query in stream_published(
        spark, folder, target, fresh_path(spark, "checkpoint"),
        available_now=True, max_bytes_per_trigger=size,
        specs={"user_state": USER_VALUES},
    ).values():
        query.awaitTermination()
    state = StagingTable.of_changes(f"{target}/user_state", USER_VALUES, SEQ_FIELD)
    return state.current(spark)


def stream_clean_query(spark, sf_dir):
    folder, size = _arriving(S.reviews(spark, sf_dir), "reviews")
    stream = (
        spark.readStream.schema(REVIEWS.schema)
        .option("maxBytesPerTrigger", size)
        .parquet(f"{folder}/reviews")
    )
    path = fresh_path(spark, "cleaned")
    (
        stream_clean(stream, REVIEWS)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", fresh_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(REVIEWS.schema).parquet(path)


_PARTS = "parts AS (SELECT product_id, product_category_name, product_length_cm FROM products)"
_LOADED = with_tables(
    f", {_PARTS} SELECT product_id, product_category_name, product_length_cm,"
    " product_category_name_english"
    " FROM parts LEFT JOIN translation USING (product_category_name)",
    "products",
    "translation",
)
_CLEAN = "left(replace(replace(replace({0}, chr(9), ' '), chr(10), ' '), chr(13), ' '), 255)"
_STAGED_REVIEWS = with_tables(
    " SELECT review_id, order_id, "
    + ", ".join(
        f"{_CLEAN.format(c)} AS {c}" for c in ("review_comment_title", "review_comment_message")
    )
    + " FROM reviews",
    "reviews",
)
_STAGED_LINES = with_tables(
    """
    SELECT product_id, seller_id, shipping_limit_date, price FROM (
        SELECT *, row_number() OVER (
            PARTITION BY product_id
            ORDER BY shipping_limit_date DESC, price DESC, seller_id DESC) AS rn
        FROM order_items_raw) WHERE rn = 1""",
    "order_items_raw",
)
_LAST_STATE = """
    SELECT * EXCLUDE (rn, op) FROM (
        SELECT user_id, seq, ts, value, op,
               row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) AS rn
        FROM changes) WHERE rn = 1"""

CHECKS = {
    "insert_if_absent": (
        insert_if_absent,
        with_tables(
            f", {_PARTS} SELECT * FROM parts WHERE product_length_cm < 20 UNION ALL"
            " SELECT * REPLACE (product_length_cm + 100 AS product_length_cm) FROM parts"
            " WHERE product_length_cm >= 20",
            "products",
        ),
    ),
    "new_rows": (
        new_rows,
        with_tables(
            """
            SELECT product_id, order_id, order_item_id FROM (
                SELECT *, row_number() OVER (PARTITION BY product_id
                                             ORDER BY order_id, order_item_id) AS rn
                FROM order_items_raw) WHERE rn = 1 AND product_id NOT IN
                    (SELECT product_id FROM products WHERE product_length_cm < 20)""",
            "products",
            "order_items_raw",
        ),
    ),
    "upsert": (
        upsert,
        with_tables(
            f""", {_PARTS}
            SELECT product_id,
                   CASE WHEN product_length_cm < 30 THEN product_category_name
                        ELSE lower(product_category_name) END AS product_category_name,
                   CASE WHEN product_length_cm > 10 THEN product_length_cm + 100
                        ELSE product_length_cm END AS product_length_cm,
                   CASE WHEN product_length_cm < 30 THEN 'kept' END AS note
            FROM parts""",
            "products",
        ),
    ),
    "append_distinct": (
        append_distinct,
        with_tables(
            " SELECT DISTINCT * FROM geolocations"
            " UNION ALL SELECT DISTINCT * FROM geolocations",
            "geolocations",
        ),
    ),
    "keep_latest": (
        keep_latest,
        """
        SELECT event_id, ts, user_id, event_type, value, props FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id
                                         ORDER BY ts DESC, event_id DESC) AS rn
            FROM events) WHERE rn = 1""",
    ),
    "apply_changes": (
        apply_changes,
        with_tables(
            """,
            last_change AS (SELECT * FROM (
                SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, seq DESC) AS rn
                FROM changes) WHERE rn = 1)
            SELECT c_custkey AS user_id, c_acctbal AS value FROM customer
            WHERE c_custkey NOT IN (SELECT user_id FROM changes)
            UNION ALL SELECT user_id, value FROM last_change WHERE op <> 'delete'""",
            "changes",
        ),
    ),
    "staging_upsert": (staging_upsert, _STAGED_LINES),
    "staging_upsert_compacted": (staging_upsert_compacted, _STAGED_LINES),
    "staging_upsert_hashed": (staging_upsert_hashed, _STAGED_LINES),
    "staging_retry_after_compact": (staging_retry_after_compact, _STAGED_LINES),
    "ordered_load": (ordered_load, _LOADED),
    "copy_jobs": (
        copy_jobs,
        with_tables(
            """
            SELECT 'products' AS table_name, 'FAILED' AS status, cast(NULL AS bigint) AS n_rows,
                   true AS names_column
            UNION ALL SELECT 'translation', 'OK', count(*), NULL FROM translation
            UNION ALL SELECT 'reviews', 'OK', count(*), NULL FROM documents
            UNION ALL SELECT 'user_state', 'OK', count(*), NULL FROM events""",
            "translation",
        ),
    ),
    "copy_jobs_hashed": (copy_jobs_hashed, _LOADED),
    "raw_reviews": (
        raw_reviews,
        with_tables(
            " SELECT review_id, order_id, review_comment_title, review_comment_message FROM reviews",
            "reviews",
        ),
    ),
    "staged_reviews": (staged_reviews, _STAGED_REVIEWS),
    "hash_layout": (
        hash_layout,
        with_tables(
            " SELECT order_id, order_item_id, product_id, seller_id, price, freight_value"
            " FROM order_items",
            "order_items_raw",
            "order_items",
        ),
    ),
    "stream_upsert": (stream_upsert_query, with_tables(_LAST_STATE, "changes")),
    "stream_new_checkpoint": (stream_new_checkpoint, with_tables(_LAST_STATE, "changes")),
    "stream_apply_changes": (
        stream_apply_changes_query,
        with_tables(_LAST_STATE + " AND op <> 'delete'", "changes"),
    ),
    "stream_clean": (stream_clean_query, _STAGED_REVIEWS),
}
