"""Parents with their children nested in pages of bounded size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.keys import assign_keys

PAGE_ROWS = 1_000


def with_child_pages(
    parent: DataFrame,
    child: DataFrame,
    on: str,
    children: str,
    order: Sequence[str],
    child_on: str | None = None,
    page_rows: int = PAGE_ROWS,
) -> DataFrame:
    """Every parent with its children as `children`, an array of structs, in pages.

    A page has up to `page_rows` children, in the order of `order` (the other columns break ties),
    and a row of its own with its number `page`, from 0. Most parents are one row; one that owns a
    third of all children is many, of which none holds more than a page. A parent without children
    has one empty page; children of no parent, or with a NULL reference, are left out.

    One range shuffle numbers the children by parent and order. The first number of each parent,
    found by partial aggregation, gives a child its place, and the pages are put together by parent
    and page, so a hot parent is spread over as many tasks as it has pages.
    """
    ref = child_on or on
    known = child.where(F.col(ref).isNotNull())
    rest = [c for c in child.columns if c not in (ref, *order)]
    rows = known.select(F.col(ref).alias("_ref"), *order, *rest).withColumn(
        "_tie", F.monotonically_increasing_id()
    )
    numbered = assign_keys(rows, ["_ref", *order, *rest, "_tie"], "_number", key_type="long")
    first = numbered.groupBy("_ref").agg(F.min("_number").alias("_first"))
    placed = numbered.join(first, "_ref").withColumn(
        "page", F.floor((F.col("_number") - F.col("_first")) / page_rows)
    )
    item = F.struct("_number", F.struct(*order, *rest).alias("item"))
    pages = (
        placed.groupBy("_ref", "page").agg(F.array_sort(F.collect_list(item)).alias("_items"))
        .select("_ref", "page", F.col("_items.item").alias(children))
    )
    full = parent.join(pages, F.col(on) == F.col("_ref")).select(*parent.columns, "page", children)
    empty = parent.join(first.select("_ref"), F.col(on) == F.col("_ref"), "left_anti").select(
        *parent.columns, F.lit(0).cast("long").alias("page"),
        F.array().cast(full.schema[children].dataType).alias(children),
    )
    return full.unionByName(empty)
