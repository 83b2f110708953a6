"""Benchmark passages in documents, found by Wu-Manber multi-pattern search.

A-Z are lower-cased and words are the runs of digits, letters and other than ASCII characters. The
patterns are the windows of an item: every `window` consecutive words, or all its words if there
are fewer. They are searched in the document's words joined by single spaces, so that a pattern
starts and ends at word borders. Patterns of similar length share one table: for each hash of a block
of bytes, how far the search may advance at least; where it may not, the patterns whose common length
ends in a block of that hash, and starts with another, are compared directly. Patterns are places in
one buffer that holds each item's words once.

A NULL text has no words. NULL items and items without words have no windows. Repeated items count
once for each id; a NULL id is listed as `null`. Empty tables give no rows, or rows without hits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.shared import written

WINDOW = 10
#: Of item text and ids in one part; its tables take some 15 times as much in each Python worker.
MAX_BYTES = 8 << 20
BLOCK = 12

_WORD = b"0123456789abcdefghijklmnopqrstuvwxyz"
_TO_WORDS = bytes(c if c > 127 or c in _WORD else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().lower().translate(_TO_WORDS).split() if text else []


class Searcher:
    """Tables for patterns whose lengths are at least `length` and less than twice as much.

    The patterns are given by their `starts` (ascending) and `ends` in `buffer` and the item of each.
    """

    def __init__(self, buffer: bytes, starts: np.ndarray, ends: np.ndarray, items: np.ndarray):
        self.length = int((ends - starts).min())
        self.block = max(1, min(BLOCK, self.length // 3))
        # steps are stored in a byte
        self.beyond = min(self.length - self.block + 1, 255)

        # the first pattern that still covers a block leaves the smallest step
        at = np.arange(len(buffer) - self.block + 1, dtype=np.int64)
        first = np.searchsorted(starts, at + self.block - self.length)
        near = starts[np.minimum(first, len(starts) - 1)]
        covered = (first < len(starts)) & (near <= at)
        at, near = at[covered], near[covered]
        steps = np.minimum(near + self.length - at - self.block, self.beyond).astype(np.uint8)
        blocks = self._hashes(buffer, at, self.block)
        self.mask = (1 << (2 * len(at)).bit_length()) - 1
        shift = np.full(self.mask + 1, self.beyond, np.uint8)
        np.minimum.at(shift, blocks & np.uint32(self.mask), steps)
        self.shift = shift.tobytes()

        key = self._hashes(buffer, starts + self.length - self.block, self.block).astype(np.uint64)
        key = key << np.uint64(32) | self._hashes(buffer, starts, self.length - self.block)
        order = np.argsort(key, kind="stable")
        self.keys = key[order]
        self.starts = starts[order].astype(np.int32)
        self.ends = ends[order].astype(np.int32)
        self.items = items[order].astype(np.int32)

    @staticmethod
    def _hashes(buffer: bytes, starts: np.ndarray, size: int) -> np.ndarray:
        found = (crc32(buffer[s : s + size]) for s in map(int, starts))
        return np.fromiter(found, np.uint32, len(starts))

    def search(self, text: bytes, buffer: bytes) -> Iterator[tuple[int, int, int]]:
        """(start, end, item) of each occurrence."""
        shift, mask, block, length = self.shift, self.mask, self.block, self.length
        end, size = length, len(text)
        while end <= size:
            ending = crc32(text[end - block : end])
            ahead = shift[ending & mask]
            if ahead:
                end += ahead
                continue
            start = end - length
            key = np.uint64(ending << 32 | crc32(text[start : end - block]))
            at = int(np.searchsorted(self.keys, key))
            while at < len(self.keys) and self.keys[at] == key:
                pattern = buffer[self.starts[at] : self.ends[at]]
                if text.startswith(pattern, start):
                    yield start, start + len(pattern), int(self.items[at])
                at += 1
            end += 1


class Passages:
    """The windows of all items; items of equal words share theirs."""

    def __init__(self, items: Iterable[tuple[str, str | None]], window: int):
        self.ids: list[set[str]] = []
        places: dict[bytes, int] = {}
        parts: list[bytes] = []
        starts, ends, owners = [], [], []
        used = 0
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            joined = b" " + b" ".join(words) + b" "
            digest = blake2b(joined, digest_size=16).digest()
            at = places.setdefault(digest, len(self.ids))
            if at < len(self.ids):
                self.ids[at].add(item_id)
                continue
            self.ids.append({item_id})
            parts.append(joined)
            borders = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32) + used
            size = min(window, len(words))
            starts.append(borders[:-size])
            ends.append(borders[size:] + 1)
            owners.append(np.full(len(borders) - size, at))
            used += len(joined)
        self.buffer = b"".join(parts)
        self.tables: list[Searcher] = []
        if parts:
            first, last, owner = map(np.concatenate, (starts, ends, owners))
            # lengths from a power of two up to the next share a table
            sizes = np.frexp((last - first).astype(float))[1]
            for kind in np.unique(sizes):
                of = sizes == kind
                self.tables.append(Searcher(self.buffer, first[of], last[of], owner[of]))

    def hits(self, text: bytes) -> Iterator[tuple[int, int, set[str]]]:
        """(first word, word after the last, ids of an item) of each occurrence in spaced text."""
        borders = None
        for table in self.tables:
            for start, end, item in table.search(text, self.buffer):
                if borders is None:
                    borders = np.flatnonzero(np.frombuffer(text, dtype=np.uint8) == 32)
                first, last = np.searchsorted(borders, (start, end - 1))
                yield int(first), int(last), self.ids[item]


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def find_passages(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, max_bytes: int = MAX_BYTES
) -> DataFrame:
    """Add `n_words`, `spans` (word ranges hit, merged) and `items` (ids, as sorted strings) to the
    columns of `docs(doc_id, text, ...)`, one row per row.

    The items(item_id, text) travel to the tasks in parts of about `max_bytes` bytes, or one item
    if that is longer; for each part the documents are searched again, so their number is
    unbounded while the memory of a task is not: the driver builds a part's tables, and each Python
    worker reads them from one broadcast. Columns of `docs` with the added names give way.
    """
    added = {"n_words": "bigint", "spans": "array<struct<start:int,end:int>>", "items": "array<string>"}
    kept = [f for f in docs.schema if f.name not in added]
    docs = docs.select(*[f"`{f.name}`" for f in kept])
    items = items.where(F.col("text").isNotNull()).select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text"
    )
    items = items.distinct()
    bytes_of = F.octet_length("text") + F.octet_length("item_id")
    total = items.agg(F.coalesce(F.sum(bytes_of), F.lit(0))).first()[0]
    parts = -(-total // max_bytes) or 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
        + [f"{name} {kind}" for name, kind in added.items()]
    )
    names = [f.name for f in kept]
    spark = docs.sparkSession
    for k in range(parts):
        chosen = items.where(part == k).toLocalIterator()
        shared = spark.sparkContext.broadcast(Passages(((r.item_id, r.text) for r in chosen), window))

        def search(batches, shared=shared, later=k > 0):
            passages = shared.value
            for batch in batches:
                n_words, spans, found = [], [], []
                for at, text in enumerate(batch["text"]):
                    words = words_of(text)
                    here = [(s["start"], s["end"]) for s in batch["spans"][at]] if later else []
                    ids = set(batch["items"][at]) if later else set()
                    joined = b" " + b" ".join(words) + b" "
                    for start, end, owners in passages.hits(joined):
                        here.append((start, end))
                        ids |= owners
                    n_words.append(len(words))
                    spans.append([{"start": s, "end": e} for s, e in merged(here)])
                    found.append(sorted(ids))
                out = batch[names].copy()
                out["n_words"], out["spans"], out["items"] = n_words, spans, found
                yield out

        docs = docs.mapInPandas(search, schema)
        if k < parts - 1:
            docs = written(docs, "passages")
    return docs


def n_hit() -> Column:
    """Words inside the spans."""
    return F.aggregate(
        "spans", F.lit(0).cast("bigint"), lambda n, s: n + (s["end"] - s["start"]).cast("bigint")
    )
