"""Change rows of a published table as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from martloom.specs import TableSpec

OP = "op"
SEQ = "seq"
DELETE = "delete"
SEQ_FIELD = T.StructField(SEQ, T.LongType())


def change_schema(spec: TableSpec) -> T.StructType:
    """Operation, sequence and the row after the change; a delete row fills the key only."""
    return T.StructType([T.StructField(OP, T.StringType()), SEQ_FIELD, *spec.schema.fields])


def read_changes(
    spark: SparkSession,
    path: str,
    spec: TableSpec,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of the change files that arrive in `path`; a micro-batch takes as many files or
    bytes as given."""
    reader = spark.readStream.schema(change_schema(spec)).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.load(path)
