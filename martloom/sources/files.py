"""CSV scans in which every column is text, and the input order of file rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.rows import null_markers
from martloom.specs import TableSpec

INPUT_ORDER = "_input_order"
# Reading mode: a row shorter than the header is filled with NULL, a longer one fails the scan.
FAIL_LONG = "FAIL_LONG"
_RECORD = "_record"
# A field that no file holds, put after the last one to see how far a record goes.
_MARK = "\x01end\x01"


def read_csv_text(
    spark: SparkSession,
    path: str | list[str],
    spec: TableSpec,
    multi_line: bool | None = None,
    line_sep: str | None = None,
    keep_order: bool = False,
    mode: str = FAIL_LONG,
) -> DataFrame:
    """Header CSV as text columns, missing markers as NULL.

    Quoted line breaks need `multi_line`, which makes each file one task; it is on only for
    tables with free text, so hand those over as many files. Where records end in CRLF and the
    breaks inside quotes are bare LF, `multi_line=False, line_sep="\\r\\n"` splits such files too.
    All other files are split. The header must name the columns of `spec`. A short row is filled
    with NULL and a long one fails the scan; `mode` FAILFAST refuses both, PERMISSIVE takes both.
    `keep_order` adds the column `_input_order`.
    """
    checked = mode == FAIL_LONG
    schema = spec.text_schema.add(_RECORD, "string") if checked else spec.text_schema
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", bool(spec.free_text) if multi_line is None else multi_line)
        .option("escape", '"')
        .option("mode", "PERMISSIVE" if checked else mode)
    )
    if checked:
        # all columns are parsed, or rows of another width would pass unseen
        reader = reader.option("columnNameOfCorruptRecord", _RECORD).option("columnPruning", False)
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    rows = reader.csv(path)
    if checked:
        rows = rows.where(_not_long(spec))
    order = [input_order().alias(INPUT_ORDER)] if keep_order else []
    return null_markers(rows.select(*spec.columns, *order), cols=spec.columns)


def _not_long(spec: TableSpec) -> Column:
    """True; fails for a record of another width that has more fields than `spec` has columns."""
    names = [f"c{i}" for i in range(len(spec.columns) + 1)]
    fields = F.from_csv(
        F.concat(F.col(_RECORD), F.lit(f",{_MARK}")),
        F.lit(", ".join(f"{n} string" for n in names)),
        {"escape": '"', "mode": "PERMISSIVE"},
    )
    short = F.array_contains(F.array(*[F.coalesce(fields[n], F.lit("")) for n in names]), _MARK)
    # naming a field keeps the scan allowed where nothing but the record is asked for
    first = F.coalesce(F.col(spec.columns[0]), F.lit(""))
    failed = F.raise_error(
        F.concat(F.lit(f"{spec.name}: row too long: "), first, F.lit(" in "), F.col(_RECORD))
    )
    return F.when(F.col(_RECORD).isNotNull() & ~short, failed.cast("boolean")).otherwise(True)


def input_order() -> Column:
    """Position of a row in its input: file, block of the file, row within the block.

    Rows of one block are read by one task in order, so the last part grows within a block
    whatever the task number is.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def with_input_order(df: DataFrame) -> DataFrame:
    """A file scan plus `_input_order`; call it on the scan, before any shuffle."""
    return df.select("*", input_order().alias(INPUT_ORDER))
