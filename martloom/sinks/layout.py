"""Hash-distributed tables: rows of one key in one bucket, so joins on it need no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A bucket is read by one task: about as much as a task should hold.
BUCKET_BYTES = 128 << 20


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that `df` reads; their content is not opened."""
    files = df.inputFiles()
    if not files:
        return 0
    listed = df.sparkSession.read.format("binaryFile").load(files).select("path", "length").distinct()
    return listed.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def bucket_count(df: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for a table made from the files of `df`: as many as keep them near `bucket_bytes`, but
    no fewer than the session's shuffle partitions."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-input_bytes(df) // bucket_bytes))


def save_hashed(
    df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str
) -> DataFrame:
    """Save `df` as the bucketed table `table` under `path` and return the table.

    `keys` should be the unique key of the table: the buckets are then even whatever the data.
    """
    (
        df.repartition(buckets, *keys)
        .write.bucketBy(buckets, *keys)
        .sortBy(*keys)
        .mode("overwrite")
        .option("path", path)
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)
