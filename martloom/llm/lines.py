"""Dropping lines that many documents share.

Lines are exploded with their positions, hashed by their normalised form (128 bits) and counted
once per document. What the count finds goes back to the documents as positions, and each document
is put together again from the positions it keeps. Only hashes and positions are exploded, texts
are shuffled once, whole. A line found in a third of all documents sends one count per task; the
join that gives it its positions has written tables on both sides, so Spark broadcasts the common
lines if they are few and splits a hot one if not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.tables import lower_ascii, text_key, unused
from martloom.shared import written

MIN_DOCUMENTS = 10
MIN_CHARS = 1

_WHITE = " \t\x0b\x0c\r\n"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hashes(text: Column, min_chars: int) -> Column:
    """A hash for each line, NULL for lines whose key is too short to count."""

    def hashed(line):
        key = F.btrim(line, F.lit(_WHITE))
        return F.when(
            F.length(key) >= min_chars,
            F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")),
        )

    return F.transform(lines_of(lower_ascii(text)), hashed)


def without_common_lines(
    docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS
) -> DataFrame:
    """`docs` with columns n_lines, n_dropped and kept_text (which replace columns of those names).

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Lines whose
    key has at least `min_chars` characters and occurs in at least `min_documents` rows go, from
    every row; the others stay as they are. Each row counts as a document, also a repeated one. A
    NULL or empty text is one empty line. An empty table gives no rows.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "kept_text")]
    docs = docs.select(*[F.col(f"`{c}`") for c in names])
    # written: both passes below need the hashes, which cost more than anything else here
    hashed = written(
        docs.select(*text_key("doc_id", "text"), _hashes(F.col("text"), min_chars).alias("hashes")),
        "line-hashes",
    )
    common = written(
        hashed.select(F.explode(F.array_distinct("hashes")).alias("h"))
        .where("h IS NOT NULL")
        .groupBy("h.h1", "h.h2")
        .count()
        .where(F.col("count") >= min_documents)
        .select("h1", "h2"),
        "common-lines",
    )
    dropped = (
        hashed.select("k1", "k2", F.posexplode("hashes").alias("at", "h"))
        .where("h IS NOT NULL")
        .select("k1", "k2", "at", "h.h1", "h.h2")
        .join(common, ["h1", "h2"], "left_semi")
        .groupBy("k1", "k2")
        .agg(F.collect_set("at").alias("dropped"))
    )
    # work columns have names that no column of the documents has
    k1, k2, places, split = unused(docs, "k1", "k2", "places", "split")
    gone = F.coalesce(places, F.array().cast("array<int>"))
    stay = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), gone)
    keys = [key.alias(name) for key, name in zip(text_key("doc_id", "text"), (k1, k2))]
    named = dropped.select(
        F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("dropped").alias(places)
    )
    joined = docs.select("*", *keys).join(named, [k1, k2], "left").select(
        "*", lines_of(F.col("text")).alias(split)
    )
    return joined.select(
        *[F.col(f"`{c}`") for c in names],
        F.size(split).cast("bigint").alias("n_lines"),
        F.size(gone).cast("bigint").alias("n_dropped"),
        F.array_join(F.transform(stay, lambda at: F.get(split, at)), "\n").alias("kept_text"),
    )
