"""Mixing sources to target weights by hash-threshold histograms.

Every row has a hash of its id and text. Per source, sizes are summed by the leading digits of that
hash, the cumulated histogram shows in which bucket the budget ends, and only that bucket is
looked at again by its next digits, until the hash is used up. Rows below the threshold found are
taken. Nothing is sorted, a smaller budget takes a subset of what a larger one takes, and the same
rows give the same choice on every run. A source with a third of all rows sends one number per
task and bucket.

Sources are few against rows: their targets are set in one window over the table of sources, which
holds one row for each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martloom.llm.tables import unused
from martloom.shared import written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0

#: 36 bits of hash, read 12 bits at a time.
HASH_DIGITS, SHIFTS = 9, (24, 12, 0)


def word_count(text: Column) -> Column:
    """Runs of other than ASCII white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("bigint")


def row_hash(doc_id: Column, text: Column) -> Column:
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (doc_id, text)]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, HASH_DIGITS), 16, 10).cast("bigint")


def source_targets(
    sized: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """(source, source_size, target) of `sized(source, size)`.

    Sources in code point order, NULL last, weigh `weights` in turn and divide `share` times all
    sizes. No target exceeds `most` times its source's size: the rest is divided anew among the
    others by weight, which ends where each gets the same level times its weight or its own limit.
    Sources without words have target 0.
    """
    every = W.partitionBy()
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    sources = (
        sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), turn))
        .withColumn("limit", most * F.col("source_size"))
        .withColumn("at", F.struct(F.col("limit") / F.col("weight"), F.row_number().over(by_name)))
    )
    earlier = W.orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    total = share * F.sum("source_size").over(every)
    left = total - F.coalesce(F.sum("limit").over(earlier), F.lit(0.0))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    levelled = sources.withColumn("level", left / weight_left).withColumn(
        "full", F.col("level") * F.col("weight") >= F.col("limit")
    )
    first_open = F.min(F.when(~F.col("full"), F.struct("at", "level"))).over(every)["level"]
    return levelled.select(
        "source",
        "source_size",
        F.when(F.col("full"), F.col("limit")).otherwise(first_open * F.col("weight")).alias("target"),
    )


def _thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, repeats, threshold): rows are taken `repeats` times, and once more if their hash
    is below the threshold."""
    edge = targets.select(
        "source",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(0).alias("repeats"),
        F.try_mod(F.col("target"), F.col("source_size").cast("double")).alias("left"),
        F.lit(None).cast("bigint").alias("bucket"),
    ).withColumn("left", F.coalesce("left", F.lit(0.0)))
    upto = W.partitionBy("source").orderBy("bucket")
    for shift in SHIFTS:
        known = edge.select(
            F.col("source").alias("of"), "repeats", "left", F.col("bucket").alias("within")
        )
        inside = F.col("source").eqNullSafe(F.col("of"))
        if shift != SHIFTS[0]:
            inside &= F.shiftright("hash", shift + 12) == F.col("within")
        histogram = (
            sized.join(known, inside)
            .groupBy("source", "repeats", "left", F.shiftright("hash", shift).alias("bucket"))
            .agg(F.sum("size").alias("size"))
            .withColumn("upto", F.sum("size").over(upto))
        )
        # the bucket in which the budget ends: the first that it doesn't cover, or else the last
        ends = F.struct((F.col("upto") <= F.col("left")).alias("covered"),
                        F.when(F.col("upto") <= F.col("left"), -F.col("bucket"))
                        .otherwise(F.col("bucket")).alias("order"), "bucket", "upto", "size")
        edge = written(
            histogram.groupBy("source", "repeats", "left").agg(F.min(ends).alias("end"))
            .select(
                "source", "repeats", "end.bucket", "end.size",
                (F.col("left") - (F.col("end.upto") - F.col("end.size"))).alias("left"),
            ),
            "edge",
        )
    # the last bucket goes in whole if that is nearer to the budget than leaving it out
    nearer = (F.col("left") > 0) & (F.col("size") - F.col("left") < F.col("left"))
    return edge.select(
        "source", "repeats", (F.col("bucket") + nearer.cast("bigint")).alias("threshold")
    )


def mix_plan(
    sized: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """(of, source_size, target, repeats, threshold), one row per source of
    `sized(source, hash, size)`, which must be cheap to read several times."""
    targets = written(source_targets(sized, weights, share, most), "targets")
    thresholds = _thresholds(sized, targets).withColumnRenamed("source", "of")
    return targets.join(thresholds, F.col("source").eqNullSafe(F.col("of"))).select(
        "of", "source_size", "target", "repeats", "threshold"
    )


def _sized(docs: DataFrame) -> DataFrame:
    return written(
        docs.select(
            "doc_id", "source",
            row_hash(F.col("doc_id"), F.col("text")).alias("hash"),
            word_count(F.col("text")).alias("size"),
        ),
        "sized",
    )


def _times(hash_column: str, repeats: str = "repeats", threshold: str = "threshold") -> Column:
    return F.col(repeats) + (F.col(hash_column) < F.col(threshold)).cast("bigint")


def mixed_sizes(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, times), one row per row of
    `docs(doc_id, text, source)`: how often the mix takes the row.

    NULL is a source of its own. Rows equal in id and text share their fate; NULL or empty texts
    have size 0. An empty table gives no rows.
    """
    sized = _sized(docs)
    plan = mix_plan(sized, weights, share, most)
    return sized.join(plan, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "source", "size", "source_size", "target", _times("hash").alias("times")
    )


def mixed(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """The rows of `docs(doc_id, text, source, ...)` as often as the mix takes them, by the rules
    of `mixed_sizes`."""
    # work columns have names that no column of the documents has
    of, repeats, threshold, hashed, again = unused(
        docs, "of", "repeats", "threshold", "hashed", "again"
    )
    plan = mix_plan(_sized(docs), weights, share, most).select(
        F.col("of").alias(of), F.col("repeats").alias(repeats), F.col("threshold").alias(threshold)
    )
    rows = docs.select("*", row_hash(F.col("doc_id"), F.col("text")).alias(hashed))
    taken = rows.join(plan, F.col("source").eqNullSafe(F.col(of)))
    times = F.array_repeat(F.lit(0), _times(hashed, repeats, threshold).cast("int"))
    return taken.select("*", F.explode(times).alias(again)).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
