"""Order MinHash fingerprints.

A text's k-mers (`k` code points; the whole text if it is shorter) are numbered by occurrence, so
that the second "abc" differs from the first. Each numbered k-mer gets a hash, whose upper bits
choose one of `BINS` bins, so that one pass serves as many independent minima (Li et al., "One
Permutation Hashing", 2012). In each bin the `kept` smallest are taken in the order in which they
stand in the text, and that tuple is hashed to 32 bits (Marcais et al., "Locality-sensitive hashing for the
edit distance", 2019). Likeness counts the bins with equal tuples among those in which either text
has any; taken to the root `kept` that estimates the Jaccard index of the k-mers, given as the
share 2j / (1 + j) of either text that both have. Equal fingerprints have likeness 1, so also two
empty texts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.grams import MULTIPLIER, mixed
from martloom.llm.tables import text_key
from martloom.operators.keys import assign_keys

K, KEPT, BINS = 8, 2, 64

_EMPTY = np.uint32(0)


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le"), dtype=np.uint32)


def kmer_hashes(points: np.ndarray, k: int = K) -> np.ndarray:
    k = min(k, len(points))
    if not k:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(points) - k + 1, dtype=np.uint64)
    for at in range(k):
        out *= MULTIPLIER
        out += points[at : at + len(out)]
    return mixed(out)


def sketch(hashes: np.ndarray, kept: int = KEPT, bins: int = BINS) -> np.ndarray:
    """A 32-bit hash for each bin, zero for an empty one, from k-mer hashes in text order."""
    out = np.full(bins, _EMPTY)
    if not len(hashes):
        return out
    # number the occurrences: sort, then count from the start of each run of equal hashes
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    at = np.arange(len(ranked))
    occurrence = at - np.maximum.accumulate(np.where(fresh, at, 0))
    numbered = mixed(ranked + occurrence.astype(np.uint64) * MULTIPLIER)
    bin_bits = int(bins).bit_length() - 1
    by_value = np.argsort(numbered)
    numbered, place = numbered[by_value], order[by_value]
    bin_of = (numbered >> np.uint64(64 - bin_bits)).astype(np.int64)
    first = np.searchsorted(bin_of, np.arange(bins))
    counts = np.diff(np.append(first, len(bin_of)))
    least = np.arange(len(bin_of)) - first[bin_of] < kept
    numbered, place, bin_of = numbered[least], place[least], bin_of[least]
    in_text = np.lexsort((place, bin_of))
    tuples = np.zeros(bins, dtype=np.uint64)
    taken = np.minimum(counts, kept)
    start = np.concatenate([[0], np.cumsum(taken)[:-1]])
    for turn in range(kept):
        has = taken > turn
        tuples[has] = mixed(tuples[has] * MULTIPLIER + numbered[in_text[start[has] + turn]])
    full = counts > 0
    out[full] = np.maximum(tuples[full] >> np.uint64(32), np.uint64(1)).astype(np.uint32)
    return out


def likeness(a: np.ndarray, b: np.ndarray, kept: int = KEPT) -> float:
    either = (a != _EMPTY) | (b != _EMPTY)
    if not either.any():
        return 1.0
    jaccard = (np.count_nonzero((a == b) & either) / np.count_nonzero(either)) ** (1 / kept)
    return 2 * jaccard / (1 + jaccard)


def _followers(keyed: DataFrame, repeated: bool) -> DataFrame:
    """(k1, k2, p1, p2, wanted): the row after the row (p1, p2), and how much of it that asks for.

    Found on ids, keys and lengths alone; the texts stay where they are.
    """
    rows = keyed.select(
        "doc_id", "k1", "k2", F.coalesce(F.length("text"), F.lit(0)).alias("n_chars")
    )
    if repeated:
        rows = rows.distinct()
    placed = assign_keys(rows, ["doc_id", "k1", "k2"], "place", key_type="bigint")
    total = F.lit(max(1, placed.count()))
    askers = placed.select(
        (F.col("place") % total + 1).alias("place"),
        F.col("k1").alias("p1"),
        F.col("k2").alias("p2"),
        F.floor(F.col("n_chars") / 4).cast("int").alias("wanted"),
    )
    return placed.join(askers, "place").select("k1", "k2", "p1", "p2", "wanted")


def _packed(keyed: DataFrame) -> DataFrame:
    """(doc_id, k1, k2, packed, print): the texts compressed one by one, which shuffles a third less
    than Spark's own compression of its blocks, and their fingerprints."""

    def pack(batches):
        packer = zstandard.ZstdCompressor()
        for batch in batches:
            out = batch[["doc_id", "k1", "k2"]].copy()
            out["packed"] = [packer.compress((t or "").encode()) for t in batch["text"]]
            out["print"] = [sketch(kmer_hashes(code_points(t))).tobytes() for t in batch["text"]]
            yield out

    kind = keyed.schema["doc_id"].dataType.simpleString()
    return keyed.mapInPandas(
        pack, f"doc_id {kind}, k1 long, k2 long, packed binary, print binary"
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """For each row of `docs(doc_id, text)`: doc_id, n_chars (code points), edited text's sha256,
    fingerprint and edited_fingerprint (hex), near_edited and near_next.

    The edited text has its last floor(n_chars / 4) code points replaced by the first as many, or
    all, of the next row's text. Next is the row with the next larger doc_id (NULL first; rows of
    one id by a hash of their text), after the last comes the first. Repeated rows count as one and
    give equal results. NULL texts are empty; an empty table gives no rows.

    Whole texts are shuffled once, by row; from there each row's beginning and fingerprint go to
    the row before it.
    """
    keyed = docs.select("doc_id", "text", *text_key("doc_id", "text"))
    repeats = keyed.groupBy("k1", "k2").count().where("count > 1").limit(1).count() > 0
    packed = _packed(keyed)
    # all columns, though not all are read: both joins below then share one shuffle
    asked = packed.join(_followers(keyed, repeats), ["k1", "k2"]).select(
        "p1", "p2", "doc_id", "packed", "print", "wanted"
    )

    def beginnings(batches):
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            texts = (unpacker.decompress(p).decode() for p in batch["packed"])
            yield pd.DataFrame(
                {
                    "p1": batch["p1"],
                    "p2": batch["p2"],
                    "start": [t[:n] for t, n in zip(texts, batch["wanted"])],
                    "next_print": batch["print"],
                }
            )

    starts = asked.mapInPandas(
        beginnings, "p1 long, p2 long, start string, next_print binary"
    )
    if repeats:
        starts = starts.dropDuplicates(["p1", "p2"])

    def fingerprints(batches):
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            columns = (batch[c] for c in ("packed", "print", "start", "next_print"))
            for packed, own, start, after in zip(*columns):
                points = code_points(unpacker.decompress(packed).decode())
                kept = points[: len(points) - len(points) // 4]
                edited = np.concatenate([kept, code_points(start)])
                own, after = (np.frombuffer(p, dtype=np.uint32) for p in (own, after))
                other = sketch(kmer_hashes(edited))
                digest = hashlib.sha256(edited.tobytes().decode("utf-32-le").encode()).hexdigest()
                out.append(
                    (len(points), digest, own.tobytes().hex(), other.tobytes().hex(),
                     likeness(own, other), likeness(own, after))
                )
            names = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                     "near_edited", "near_next"]
            made = pd.DataFrame(out, columns=names)
            made.insert(0, "doc_id", batch["doc_id"])
            yield made

    kind = docs.schema["doc_id"].dataType.simpleString()
    both = packed.join(starts, (F.col("k1") == F.col("p1")) & (F.col("k2") == F.col("p2")))
    return both.select("doc_id", "packed", "print", "start", "next_print").mapInPandas(
        fingerprints,
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double",
    )
