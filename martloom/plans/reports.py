"""Reports over the star: totals at every level of time and product, and running totals."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.calendar import date_id
from martloom.shared import written


def sales_rollup(
    fact: DataFrame, orders: DataFrame, dim_product: DataFrame, dim_time: DataFrame
) -> DataFrame:
    """Lines, price and freight by year, quarter, month and category, with all subtotals.

    `level` is the grouping id: 0 for single months and categories, 1 for months, 3 for quarters, 7
    for years, 15 for the grand total. Lines of unknown products count under a NULL category. The
    fact's lines are reduced to one row per month and category and task before anything is shuffled
    for the totals.
    """
    day = F.col("order_purchase_timestamp").cast("date")
    dated = orders.select("order_id", date_id(day).alias("date_id"))
    products = dim_product.select("product_key", "product_category")
    lines = (
        fact.join(dated, "order_id").join(dim_time.select("date_id", "year", "quarter", "month"), "date_id")
        .join(products, "product_key", "left")
    )
    return lines.rollup("year", "quarter", "month", "product_category").agg(
        F.grouping_id().alias("level"),
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("item_price").alias("price"),
        F.sum("freight_value").alias("freight"),
    )


def running_total(
    df: DataFrame, order: Sequence[str], value: Column, name: str
) -> DataFrame:
    """`df` with `name`: the sum of `value` over all rows up to its own, by `order` (NULLs first), which
    must tell all rows apart. A NULL counts as nothing.

    One range shuffle sorts the rows; each task's rows are summed up where they are, and the total of
    all tasks before is added, of which the driver sees one number per task. The rows are written in
    between, so a repeated task can't change the order.
    """
    by = [F.col(c).asc_nulls_first() for c in order]
    placed = written(
        df.repartitionByRange(*by).withColumns(
            {"_part": F.spark_partition_id(), "_value": F.coalesce(value, value * 0, F.lit(0))}
        ),
        "ordered",
    )
    totals = {r._part: r.total for r in placed.groupBy("_part").agg(F.sum("_value").alias("total")).collect()}
    parts = sorted(totals)
    before = dict(zip(parts, accumulate([0, *[totals[p] for p in parts[:-1]]])))
    kind = placed.select(F.sum("_value").alias("s")).schema["s"].dataType
    offsets = placed.sparkSession.createDataFrame(
        [(p, str(before[p])) for p in parts], "_part int, _before string"
    ).select("_part", F.col("_before").cast(kind))
    within = Window.partitionBy("_part").orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.withColumn("_sum", F.sum("_value").over(within))
    return summed.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_sum") + F.col("_before")).cast(kind).alias(name)
    )
