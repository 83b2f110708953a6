"""Loads of several tables: full refresh, load order, copy jobs with a report."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable, Mapping, Sequence
from functools import partial, reduce
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martloom.functions.text import staged_text, truncate_text
from martloom.operators.rows import project
from martloom.shared import side_by_side
from martloom.sinks.layout import save_hashed
from martloom.sinks.staging import StagingTable
from martloom.specs import SOURCE_TABLES, TableSpec


def load_full(
    df: DataFrame,
    path: str,
    table: str | None = None,
    keys: Sequence[str] = (),
    buckets: int | None = None,
) -> int:
    """Replace the table at `path`; the number of rows is counted while they are written.

    With `buckets` it is hash-distributed by `keys` and entered in the catalog as `table`.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n_rows"))
    if buckets:
        save_hashed(counted, table, keys, buckets, path)
    else:
        counted.write.mode("overwrite").parquet(path)
    return seen.get["n_rows"]


def checked_load(
    df: DataFrame, path: str, spec: TableSpec, parents: Mapping[str, DataFrame] = {}
) -> DataFrame:
    """Replace the table at `path` and count what violates `spec` in the same pass.

    Returns (table_name, check_name, subject, n_violations) as `check_table` does, for required
    values, text lengths and references to the `parents` given; a repeated key needs a pass of its
    own. The rows are written whatever is found. Parents' keys are looked up by left joins, in which
    a hot reference can be split.
    """
    rows = project(df, spec)
    measures = [
        *[("not_null", c, F.count_if(F.col(c).isNull())) for c in spec.required],
        *[("length", c, F.count_if(F.length(c) > n)) for c, n in spec.text_limits.items()],
    ]
    for n, ref in enumerate(r for r in spec.references if r.parent in parents):
        known = parents[ref.parent].select(
            *[F.col(p).alias(f"_{n}_{c}") for c, p in zip(ref.columns, ref.parent_columns)]
        ).distinct()
        pairs = [F.col(c) == F.col(f"_{n}_{c}") for c in ref.columns]
        rows = rows.join(known, reduce(lambda a, b: a & b, pairs), "left")
        stated = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ref.columns])
        orphan = stated & F.col(f"_{n}_{ref.columns[0]}").isNull()
        measures.append(("reference", ref.parent, F.count_if(orphan)))
    seen = Observation()
    counted = rows.observe(seen, *[m.alias(f"m{n}") for n, (_, _, m) in enumerate(measures)])
    counted.select(*spec.columns).write.mode("overwrite").parquet(path)
    found = seen.get
    return df.sparkSession.createDataFrame(
        [(spec.name, check, subject, found[f"m{n}"]) for n, (check, subject, _) in enumerate(measures)],
        "table_name string, check_name string, subject string, n_violations long",
    )


def load_order(specs: Iterable[TableSpec]) -> list[str]:
    """Table names with every parent before its children."""
    chosen = {s.name: s for s in specs}
    return list(
        TopologicalSorter(
            {
                name: [r.parent for r in spec.references if r.parent in chosen]
                for name, spec in chosen.items()
            }
        ).static_order()
    )


def load_all(
    frames: Mapping[str, DataFrame],
    target: str,
    specs: Mapping[str, TableSpec] = SOURCE_TABLES,
    buckets: int | None = None,
    prefix: str = "hashed_",
) -> dict[str, int]:
    """Full refresh of each table, parents first; tables written before a failure stay.

    With `buckets` every table is hash-distributed by its key, as `<prefix><name>` in the catalog.
    """
    return {
        name: load_full(
            project(frames[name], specs[name]), f"{target}/{name}", f"{prefix}{name}",
            specs[name].key, buckets,
        )
        for name in load_order(specs[n] for n in frames)
    }


def staged(
    df: DataFrame, spec: TableSpec, raw: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """The columns of `spec` as staging takes them, after the `keep` columns.

    A table with free text has it cleaned and all its text cut to the limits; other tables, and
    any table when `raw`, are copied as they are.
    """
    missing = [c for c in spec.columns if c not in df.columns]
    if missing:
        raise ValueError(f"{spec.name} lacks {', '.join(missing)}")

    def value(c: str):
        limit = spec.text_limits.get(c)
        if limit is None:
            return F.col(c)
        fit = staged_text if c in spec.free_text else truncate_text
        return fit(F.col(c), limit).alias(c)

    as_is = raw or not spec.free_text
    return df.select(*keep, *[c if as_is else value(c) for c in spec.columns])


def run_copies(
    spark: SparkSession,
    read: Callable[[TableSpec], DataFrame],
    target: str,
    names: Sequence[str] | None = None,
    specs: Mapping[str, TableSpec] = SOURCE_TABLES,
    at_once: int = 4,
    raw: Collection[str] = (),
    keys: Mapping[str, Sequence[str]] | None = None,
    order: Mapping[str, Sequence[str]] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Copy all tables, or those named, into staging; a failed copy does not stop the others.

    `at_once` copies run side by side. Tables in `raw` are copied without cleaning, `keys` gives
    some tables another key than that of their spec. Of rows with one key the last by the table's
    `order` columns stays; without such columns, or where they tie, a repeated key fails the copy.
    `buckets` is the number of key buckets of tables that do not exist yet. Returns (table_name,
    status, n_rows, error), one row per copy.
    """

    def copy(name: str):
        seen = Observation()
        try:
            spec = specs[name]
            table = StagingTable.of(
                f"{target}/{name}", spec, (order or {}).get(name, ()), buckets,
                (keys or {}).get(name), unique=True,
            )
            table.create_if_absent(spark)
            rows = staged(read(spec), spec, raw=name in raw)
            table.upsert(rows.observe(seen, F.count(F.lit(1)).alias("n_rows")))
            return name, "OK", seen.get["n_rows"], None
        except Exception as failure:  # whatever one copy raises, the others still run
            return name, "FAILED", None, f"{type(failure).__name__}: {failure}"

    jobs = {name: partial(copy, name) for name in names or specs}
    report = list(side_by_side(spark, jobs, at_once).values())
    return spark.createDataFrame(
        report, "table_name string, status string, n_rows long, error string"
    )
