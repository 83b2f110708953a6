"""SimHash fingerprints of word shingles and the groups that they form.

A text's A-Z are lower-cased, its words are the runs of other than ASCII white space, a shingle is
`words` consecutive words joined by one space (all words, if there are fewer; repeats count). Bit i
is set if more than half of the shingles' XXH64 values have it set. A NULL text, or one without
words, has the fingerprint zero, which is linked like any other.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.components import components
from martloom.llm.tables import text_key, unused
from martloom.llm.vptree import near_edges
from martloom.shared import written

SEED = 42


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 values of the text's shingles in their order, none for a text without words."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not tokens:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = min(words, len(tokens)) - 1
    digest = xxhash.xxh64_intdigest
    return np.array(
        [
            digest(joined[s:e], SEED)
            for s, e in zip(starts[: len(tokens) - last].tolist(), ends[last:].tolist())
        ],
        dtype=np.uint64,
    )


def simhash(text: str | None, words: int) -> bytes:
    """8 bytes, high byte first."""
    hashes = shingle_hashes(text, words)
    ones = np.zeros(64, dtype=np.int64)
    # summed in slices: a long text needs no matrix of all its bits at once
    for at in range(0, len(hashes), 1 << 14):
        raw = hashes[at : at + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes)).tobytes()


def with_fingerprints(docs: DataFrame, keep: list[str], words: int) -> DataFrame:
    """The columns `keep` of `docs(text, ...)` and the fingerprint `fp`, one row per row."""

    def fingerprints(batches):
        for batch in batches:
            out = batch[keep].copy()
            out["fp"] = [simhash(t, words) for t in batch["text"]]
            yield out

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, "text").mapInPandas(fingerprints, f"{schema}, fp binary")


def _rooted(rows: DataFrame, least: Column, radius: int, blocks: int) -> DataFrame:
    """(fp, least, root): each distinct fingerprint with the least of its rows and its group.

    Rows of equal fingerprints are one node of the graph, whatever their number.
    """
    nodes = written(rows.groupBy("fp").agg(F.min(least).alias("least")), "nodes")
    edges = near_edges(nodes.select("fp"), 64, radius, blocks)
    linked = components(edges).withColumnRenamed("node", "fp")
    return nodes.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_groups(docs: DataFrame, words: int, radius: int, blocks: int) -> DataFrame:
    """(doc_id, fp, component_id), one row per row of `docs(doc_id, text)`.

    Fingerprints within `radius` bits are linked; component_id is the smallest doc_id of the
    linked group, NULL only if all its ids are. An empty table gives no rows.
    """
    rows = written(with_fingerprints(docs, ["doc_id"], words), "fingerprints")
    rooted = _rooted(rows, F.col("doc_id"), radius, blocks)
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def deduplicated(docs: DataFrame, words: int, radius: int, blocks: int) -> DataFrame:
    """The rows of `docs(doc_id, text, ...)` that stand for the groups of `near_groups`: of each group
    the row with the smallest doc_id (NULL last, then by a hash of the text), once if it repeats.

    All columns stay, whatever their names. An empty table gives no rows. Texts are shuffled once.
    """
    k1, k2 = unused(docs, "k1", "k2")
    keys = [key.alias(name) for key, name in zip(text_key("doc_id", "text"), (k1, k2))]
    keyed = docs.select("doc_id", *text_key("doc_id", "text"), "text")
    rows = written(with_fingerprints(keyed, ["doc_id", "k1", "k2"], words), "fingerprints")
    least = F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2")
    first = _rooted(rows, least, radius, blocks).groupBy("root").agg(F.min("least").alias("least"))
    winners = first.select(F.col("least.k1").alias(k1), F.col("least.k2").alias(k2))
    chosen = docs.select("*", *keys).join(winners, [k1, k2], "left_semi")
    return chosen.dropDuplicates([k1, k2]).select(*[F.col(f"`{c}`") for c in docs.columns])
