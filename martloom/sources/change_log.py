"""Change files as a data source of their own: `spark.readStream.format("change_log")`.

A folder holds parquet files whose names, subfolders included, ascend as they arrive (such as
`00017/part-....parquet`). An offset is the name of the last file taken. A micro-batch takes the files
after the offset of the one before, up to `maxFiles` of them; each file is read by a task of its own,
in Arrow batches. A restarted query goes on at the offset in its checkpoint.

The folder is listed and read through Arrow's file systems (local and mounted folders, HDFS, S3, GCS);
folders that only Spark can open are read by `sources.changes.read_changes`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from martloom.sources.changes import change_schema
from martloom.specs import TableSpec

FORMAT = "change_log"
MAX_FILES = 1_000


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        path = "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(path)


class ChangeFile(InputPartition):
    def __init__(self, name: str):
        super().__init__(name)
        self.name = name


class ChangeLogReader(DataSourceStreamReader):
    def __init__(self, path: str, schema: T.StructType, max_files: int):
        self.path, self.schema, self.max_files = path, schema, max_files
        self.taken: str | None = None  # after a restart unknown until the first files are taken

    def _names(self, after: str) -> list[str]:
        files, folder = _opened(self.path)
        found = files.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True))
        names = (f.path[len(folder) :].lstrip("/") for f in found if f.is_file)
        kept = (n for n in names if not any(p.startswith(("_", ".")) for p in n.split("/")))
        return sorted(n for n in kept if n > after)

    def initialOffset(self) -> dict:
        self.taken = ""
        return {"last": ""}

    def latestOffset(self) -> dict:
        names = self._names(self.taken or "")
        # a restarted reader does not know yet where the query stands: it offers all there is, once
        if self.taken is not None:
            names = names[: self.max_files]
        return {"last": names[-1] if names else self.taken or ""}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self.taken = max(end["last"], self.taken or "")
        return [ChangeFile(n) for n in self._names(start["last"]) if n <= end["last"]]

    def read(self, partition: ChangeFile) -> Iterator[pa.RecordBatch]:
        files, folder = _opened(self.path)
        wanted = pa.schema([(f.name, _arrow(f.dataType)) for f in self.schema])
        with files.open_input_file(f"{folder}/{partition.name}") as file:
            held = pq.ParquetFile(file)
            present = [f.name for f in wanted if f.name in held.schema_arrow.names]
            for batch in held.iter_batches(columns=present):
                # columns that a file lacks, such as those beside the key of deleted rows, are NULL
                columns = [
                    batch.column(f.name).cast(f.type) if f.name in present
                    else pa.nulls(batch.num_rows, f.type)
                    for f in wanted
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=wanted)

    def commit(self, end: dict) -> None:
        self.taken = max(end["last"], self.taken or "")


def _arrow(kind: T.DataType) -> pa.DataType:
    """The Arrow types of the columns that change rows have."""
    known = {
        T.StringType(): pa.string(), T.IntegerType(): pa.int32(), T.LongType(): pa.int64(),
        T.DoubleType(): pa.float64(), T.BooleanType(): pa.bool_(), T.DateType(): pa.date32(),
        T.TimestampNTZType(): pa.timestamp("us"),
    }
    if isinstance(kind, T.DecimalType):
        return pa.decimal128(kind.precision, kind.scale)
    return known[kind]


class ChangeLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        raise ValueError("state the schema of the changes: spark.readStream.schema(...)")

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        files = int(self.options.get("maxFiles", MAX_FILES))
        return ChangeLogReader(self.options["path"], schema, files)


def read_change_log(
    spark: SparkSession, path: str, spec: TableSpec, max_files: int = MAX_FILES
) -> DataFrame:
    """Stream of the change rows of one table, from the files that arrive in `path`."""
    spark.dataSource.register(ChangeLog)
    reader = spark.readStream.format(FORMAT).schema(change_schema(spec))
    return reader.option("path", path).option("maxFiles", max_files).load()
