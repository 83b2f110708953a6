"""Queries for nested children, checked loads, history, reports and streams with state."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import standins as S
from checks.load_queries import _LAST_STATE, USER_VALUES, _user_changes
from checks.quality_queries import CHECKS as QUALITY_CHECKS
from checks.quality_queries import ITEMS
from checks.standins import table, with_tables
from checks.star_queries import _FACT_TABLES, _fact_inputs
from martloom.operators.history import DAY, asof_join, valid_at, validity
from martloom.operators.pages import with_child_pages
from martloom.plans import reports, star
from martloom.shared import fresh_path
from martloom.sinks.loads import checked_load as load_and_check
from martloom.sinks.staging import StagingTable
from martloom.streaming.state import stream_apply_newest, window_totals
from martloom.sources.change_log import read_change_log
from martloom.sources.changes import SEQ_FIELD
from martloom.streaming.upsert import stream_apply_changes, stream_changes

PAGE_ROWS = 4
YEARS_AHEAD = 26  # brings the orders into the time of the events
WINDOWS = {"window": "1 day", "delay": "3 days"}


def parent_child_nested(spark, sf_dir):
    """Sellers with their order lines in pages; the lines are shown as text to be compared."""
    sellers = S.sellers(spark, sf_dir).select("seller_id", "seller_city")
    lines = S.order_items_raw(spark, sf_dir)
    paged = with_child_pages(
        sellers, lines, "seller_id", "lines", ["order_id", "order_item_id"], page_rows=PAGE_ROWS * 25
    )
    shown = F.transform(
        "lines", lambda x: F.concat_ws(":", x["order_id"], x["order_item_id"], x["product_id"])
    )
    return paged.select(
        "seller_id", "seller_city", "page", F.size("lines").cast("bigint").alias("n_lines"),
        F.array_join(shown, " ").alias("lines"),
    )


def customer_orders_nested(spark, sf_dir):
    """Customers with their orders in small pages; customers without orders have an empty one."""
    paged = with_child_pages(
        S.customers(spark, sf_dir).select("customer_id"), S.source_orders(spark, sf_dir),
        "customer_id", "orders", ["order_purchase_timestamp", "order_id"], page_rows=PAGE_ROWS,
    )
    return paged.select(
        "customer_id", "page", F.size("orders").cast("bigint").alias("n_orders"),
        F.array_join("orders.order_id", ",").alias("order_ids"),
        F.array_max("orders.order_purchase_timestamp").alias("last_purchase"),
    )


def checked_load(spark, sf_dir):
    """The checks of `check_table` but the key's, counted while the lines are written."""
    products = S.products(spark, sf_dir).where("product_length_cm > 0")
    parents = {"products": products, "sellers": S.sellers(spark, sf_dir)}
    lines = S.order_items_raw(spark, sf_dir)
    return load_and_check(lines, fresh_path(spark, "load"), ITEMS, parents)


def _later_orders(spark, sf_dir):
    return S.source_orders(spark, sf_dir).select(
        "order_id", F.col("customer_id").cast("long").alias("user_id"),
        (F.col("order_purchase_timestamp") + F.make_ym_interval(F.lit(YEARS_AHEAD))).alias("bought"),
    )


def asof_events(spark, sf_dir):
    """Every order with the last event of its customer before it."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    return asof_join(_later_orders(spark, sf_dir), events, ["user_id"], "bought", "ts")


def user_history(spark, sf_dir):
    """The changes of users as validity intervals, from and to."""
    return validity(S.changes(spark, sf_dir), ["user_id"], "ts", "seq", F.col("op") == "delete")


def orders_at_state(spark, sf_dir):
    """Every order with the state of its customer that was valid at its time."""
    history = user_history(spark, sf_dir).select("user_id", "value", "valid_from", "valid_to")
    orders = _later_orders(spark, sf_dir)
    last = F.lit(orders.agg(F.max("bought")).first()[0])
    return valid_at(orders, history, ["user_id"], "bought", last, bucket_seconds=7 * DAY)


def sales_rollup(spark, sf_dir):
    items, orders, dims = _fact_inputs(spark, sf_dir)
    fact = star.build_fact_order_item(items, orders, dims)
    days = orders.select(F.col("order_purchase_timestamp").cast("date").alias("d"))
    first, last = days.agg(F.min("d"), F.max("d")).first()
    products = dims["dim_product"].withColumnRenamed("product_category_name", "product_category")
    return reports.sales_rollup(fact, orders, products, star.build_dim_time(spark, first, last))


def running_sales(spark, sf_dir):
    """Every order with the total of all orders up to it."""
    orders = S.order_payments(spark, sf_dir).join(S.source_orders(spark, sf_dir), "order_id").select(
        F.col("order_id").cast("long").alias("order_number"), "order_purchase_timestamp",
        F.col("payment_value").cast("decimal(12,2)").alias("payment"),
    )
    return reports.running_total(
        orders, ["order_purchase_timestamp", "order_number"], F.col("payment"), "sales"
    )


def stream_changes_stateful(spark, sf_dir):
    """Changes kept in order by the stream's own state; the target has no sequence column."""
    folder, size = _user_changes(spark, sf_dir)
    stream = stream_changes(spark, USER_VALUES, f"{folder}/user_state", max_bytes_per_trigger=size)
    target = StagingTable.of(fresh_path(spark, "staging"), USER_VALUES)
    stream_apply_newest(
        stream, target, fresh_path(spark, "checkpoint"), available_now=True
    ).awaitTermination()
    return target.current(spark)


def stream_change_log(spark, sf_dir):
    """Changes that arrive in four parts, each taken up by a restarted query at its offset."""
    changes = S.changes(spark, sf_dir).select("op", "seq", "user_id", "ts", "value")
    folder, checkpoint = fresh_path(spark, "arriving"), fresh_path(spark, "checkpoint")
    target = StagingTable.of_changes(fresh_path(spark, "staging"), USER_VALUES, SEQ_FIELD)
    for part in range(4):
        changes.where(F.col("seq") % 4 == part).write.parquet(f"{folder}/{part:05d}")
        stream = read_change_log(spark, folder, USER_VALUES)
        stream_apply_changes(stream, target, checkpoint, available_now=True).awaitTermination()
    return target.current(spark)


def event_windows(spark, sf_dir):
    """Totals by day and kind of event. The events come in five parts by day, every seventh event two
    parts late; what comes after the watermark is dropped."""
    events = table(spark, sf_dir, "events")
    first, last = events.agg(F.min("ts").cast("date"), F.max("ts").cast("date")).first()
    days = (last - first).days + 1
    part = F.floor(5 * F.date_diff(F.col("ts").cast("date"), F.lit(first)) / days)
    late = F.when(F.col("event_id") % 7 == 0, 2).otherwise(0)
    arriving = events.withColumn("part", (part + late).cast("int"))
    folder, path, checkpoint = (fresh_path(spark, n) for n in ("arriving", "windows", "checkpoint"))
    totals = [F.count(F.lit(1)).alias("n_events"), F.round(F.sum("value"), 4).alias("value")]
    for number in sorted(r.part for r in arriving.select("part").distinct().collect()):
        arriving.where(F.col("part") == number).drop("part").write.mode("append").parquet(folder)
        stream = spark.readStream.schema(events.schema).parquet(folder)
        (
            window_totals(stream, "ts", WINDOWS["window"], WINDOWS["delay"], ["event_type"], totals)
            .writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
            .awaitTermination()
        )
    return spark.read.parquet(path)


_EVENT_WINDOWS = """
WITH e AS (
    SELECT *, date_trunc('day', ts)::TIMESTAMP AS window_start,
           5 * date_diff('day', (min(ts) OVER ())::DATE, ts::DATE)
               // (date_diff('day', (min(ts) OVER ())::DATE, (max(ts) OVER ())::DATE) + 1)
           + CASE WHEN event_id % 7 = 0 THEN 2 ELSE 0 END AS part
    FROM events),
marks AS (
    SELECT part, max(date_trunc('millisecond', max(ts))) OVER (
               ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
           - INTERVAL 3 DAY AS late
    FROM e GROUP BY part)
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, event_type,
       count(*) AS n_events, round(sum(value), 4) AS value
FROM e JOIN marks USING (part)
WHERE (late IS NULL OR window_start + INTERVAL 1 DAY > late)
  AND window_start + INTERVAL 1 DAY <=
      (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 3 DAY FROM events)
GROUP BY ALL"""

_LATER = (
    "later AS (SELECT order_id, cast(customer_id AS bigint) AS user_id,"
    f" order_purchase_timestamp + INTERVAL {YEARS_AHEAD} YEAR AS bought FROM source_orders)"
)
_HISTORY = """
    history AS (
        SELECT * FROM (
            SELECT *, ts AS valid_from,
                   lead(ts) OVER (PARTITION BY user_id ORDER BY ts, seq) AS valid_to
            FROM changes)
        WHERE op <> 'delete' AND (valid_to IS NULL OR valid_to > valid_from))"""

CHECKS = {
    "parent_child_nested": (
        parent_child_nested,
        with_tables(
            f"""
            SELECT s.seller_id, seller_city, coalesce(page, 0) AS page, count(order_id) AS n_lines,
                   coalesce(string_agg(order_id || ':' || order_item_id || ':' || product_id, ' '
                                       ORDER BY n), '') AS lines
            FROM sellers s LEFT JOIN (
                SELECT *, (n - 1) // {PAGE_ROWS * 25} AS page FROM (
                    SELECT *, row_number() OVER (
                        PARTITION BY seller_id ORDER BY order_id, order_item_id, product_id,
                            shipping_limit_date, price, freight_value) AS n
                    FROM order_items_raw)) i ON i.seller_id = s.seller_id
            GROUP BY ALL""",
            "sellers",
            "order_items_raw",
        ),
    ),
    "customer_orders_nested": (
        customer_orders_nested,
        with_tables(
            f"""
            SELECT c.customer_id, coalesce(page, 0) AS page, count(order_id) AS n_orders,
                   coalesce(string_agg(order_id, ',' ORDER BY n), '') AS order_ids,
                   max(order_purchase_timestamp) AS last_purchase
            FROM customers c LEFT JOIN (
                SELECT *, (n - 1) // {PAGE_ROWS} AS page FROM (
                    SELECT *, row_number() OVER (
                        PARTITION BY customer_id ORDER BY order_purchase_timestamp, order_id) AS n
                    FROM source_orders)) o ON o.customer_id = c.customer_id
            GROUP BY ALL""",
            "customers",
            "source_orders",
        ),
    ),
    "checked_load": (
        checked_load,
        f"SELECT * FROM ({QUALITY_CHECKS['check_table'][1]}) WHERE check_name <> 'key'",
    ),
    "asof_events": (
        asof_events,
        with_tables(
            f""", {_LATER}
            SELECT order_id, later.user_id, bought, ts, event_id, value
            FROM later ASOF LEFT JOIN events ON later.user_id = events.user_id AND ts <= bought""",
            "source_orders",
        ),
    ),
    "user_history": (user_history, with_tables(f", {_HISTORY} SELECT * FROM history", "changes")),
    "orders_at_state": (
        orders_at_state,
        with_tables(
            f""", {_LATER}, {_HISTORY}
            SELECT later.*, value, valid_from, valid_to FROM later LEFT JOIN history
                ON history.user_id = later.user_id AND bought >= valid_from
                   AND (valid_to IS NULL OR bought < valid_to)""",
            "source_orders",
            "changes",
        ),
    ),
    "sales_rollup": (
        sales_rollup,
        _FACT_TABLES
        + """
        SELECT year, quarter, month, product_category,
               grouping(year, quarter, month, product_category) AS level, count(*) AS n_lines,
               sum(item_price) AS price, sum(freight) AS freight
        FROM (
            SELECT isoyear(d)::INTEGER AS year, quarter(d)::INTEGER AS quarter,
                   month(d)::INTEGER AS month, product_category_name AS product_category,
                   item_price, freight_value AS freight
            FROM (SELECT l.*, o.order_purchase_timestamp::DATE AS d, p.product_category_name
                  FROM looked_up l JOIN source_orders o USING (order_id)
                  JOIN dim_product p USING (product_key)
                  WHERE customer_key IS NOT NULL AND seller_key IS NOT NULL
                    AND order_status_key IS NOT NULL))
        GROUP BY ROLLUP (year, quarter, month, product_category)""",
    ),
    "running_sales": (
        running_sales,
        """
        SELECT o_orderkey AS order_number, o_orderdate AS order_purchase_timestamp,
               o_totalprice::DECIMAL(12, 2) AS payment,
               sum(o_totalprice::DECIMAL(12, 2)) OVER (ORDER BY o_orderdate, o_orderkey)
                   ::DECIMAL(22, 2) AS sales
        FROM orders""",
    ),
    "stream_changes_stateful": (
        stream_changes_stateful,
        with_tables(
            """
            SELECT user_id, ts, value FROM (
                SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) AS rn
                FROM changes) WHERE rn = 1 AND op <> 'delete'""",
            "changes",
        ),
    ),
    "stream_change_log": (
        stream_change_log, with_tables(_LAST_STATE + " AND op <> 'delete'", "changes")
    ),
    "event_windows": (event_windows, _EVENT_WINDOWS),
}
