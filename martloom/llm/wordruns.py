"""Runs of words: maximal stretches of a text that repeat a shorter stretch several times over.

A run of period q is a stretch of consecutive words in which words q apart are the same, q being the
smallest such number, and which no neighbouring word extends.

Runs are read off a suffix automaton. Its suffix links form a tree; the way from the state of a
prefix to the root holds all its suffixes, and every state on it has an end where it occurred last.
The words are taken one after another, and the way of each is recoloured with its end, by the access
of a link-cut tree: states that share their last end are one segment, and a segment with the last
end p and the longest suffix of m words says that those m words before the new end e also stand
before p. If e - p <= m the two overlap or meet: a square of period e - p. With m as many times the
period as asked for, the start e - (e - p) - m + 1 is the start of a run, which lasts as long as the
words that follow find it again.

Only stretches that can hold a run get an automaton: in a run of period q each word, and each group
of four words, stands at most q words after its like. Stretches without enough of these in a row for
any q hold no run, so nothing is lost. Words are compared by a hash there and themselves in the
automaton.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from martloom.llm.tables import text_ranges

TIMES = 4
LEAST = 6
# Words that are compared together where the period is more than four.
GROUP = 4
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _back(keys: np.ndarray) -> np.ndarray:
    """How far back each key's like is, as much as there are keys if there is none."""
    out = np.full(len(keys), len(keys), dtype=np.int64)
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    out[order[1:][same]] = (order[1:] - order[:-1])[same]
    return out


def candidates(hashes: np.ndarray, times: int = TIMES, least: int = LEAST) -> list[tuple[int, int]]:
    """Separate ranges [start, stop) of words, in which all runs lie; each reaches one word further."""
    n = len(hashes)
    marks = np.zeros(n + 1, dtype=np.int64)
    if n < least:
        return []
    single = _back(hashes)
    grouped = hashes[: n - GROUP + 1].copy()
    for at in range(1, GROUP):
        grouped = grouped * _MULTIPLIER + hashes[at : n - GROUP + 1 + at]
    # a group is marked at its last word
    group = np.concatenate([np.full(GROUP - 1, n), _back(grouped)])
    top = 1
    while top // 2 < n // times:
        size, back = (1, single) if top <= GROUP else (GROUP, group)
        # periods in (top / 2, top]; behind its first period a run has so many words, or groups
        wanted = max((times - 1) * (top // 2 + 1), least - top) - size + 1
        near = np.flatnonzero(np.diff(np.concatenate([[0], back <= top, [0]]).astype(np.int8)))
        starts, stops = near[::2], near[1::2]
        long = stops - starts >= wanted
        np.add.at(marks, np.maximum(starts[long] - top - size, 0), 1)
        np.add.at(marks, np.minimum(stops[long] + 1, n), -1)
        top *= 2
    covered = np.cumsum(marks[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered, [0]]).astype(np.int8))).tolist()
    return list(zip(edges[::2], edges[1::2]))


def automaton(words: list) -> tuple[list[int], list[int], list[int]]:
    """Suffix links and lengths of the states of the words' suffix automaton, and each prefix's state."""
    follow: list[dict] = [{}]
    links, sizes, prefixes, last = [-1], [0], [], 0
    for word in words:
        state = len(sizes)
        follow.append({})
        sizes.append(sizes[last] + 1)
        links.append(0)
        at = last
        while at >= 0 and word not in follow[at]:
            follow[at][word] = state
            at = links[at]
        if at >= 0:
            target = follow[at][word]
            if sizes[target] == sizes[at] + 1:
                links[state] = target
            else:
                clone = len(sizes)
                follow.append(follow[target].copy())
                sizes.append(sizes[at] + 1)
                links.append(links[target])
                while at >= 0 and follow[at].get(word) == target:
                    follow[at][word] = clone
                    at = links[at]
                links[target] = links[state] = clone
        prefixes.append(state)
        last = state
    return links, sizes, prefixes


class LastEnds:
    """A link-cut tree over the suffix links. Its preferred paths, kept as splay trees by depth, are
    the segments of states that share the end where they occurred last (-1: not yet)."""

    def __init__(self, links: list[int], sizes: list[int]):
        self.sizes = sizes
        self.parent = links.copy()
        self.above, self.below = [-1] * len(links), [-1] * len(links)
        self.ends = [-1] * len(links)  # at the root of each splay tree

    def _splay(self, node: int) -> None:
        parent, above, below, ends = self.parent, self.above, self.below, self.ends
        while True:
            middle = parent[node]
            if middle < 0 or (above[middle] != node and below[middle] != node):
                return
            top = parent[middle]
            inner = top >= 0 and (above[top] == middle or below[top] == middle)
            if inner:
                straight = (above[top] == middle) == (above[middle] == node)
                self._rotate(middle if straight else node)
                self._rotate(node)
            else:
                self._rotate(node)

    def _rotate(self, node: int) -> None:
        parent, above, below = self.parent, self.above, self.below
        old = parent[node]
        up = parent[old]
        if up >= 0 and above[up] == old:
            above[up] = node
        elif up >= 0 and below[up] == old:
            below[up] = node
        else:  # the old node was the root of its splay tree
            self.ends[node] = self.ends[old]
        if above[old] == node:
            moved = above[old] = below[node]
            below[node] = old
        else:
            moved = below[old] = above[node]
            above[node] = old
        if moved >= 0:
            parent[moved] = old
        parent[old], parent[node] = node, up

    def access(self, state: int, end: int) -> list[tuple[int, int]]:
        """Colour the way from `state` to the root with `end`. Returns (longest suffix, last end) of
        the segments it had before, from the state up."""
        ends, below = self.ends, self.below
        found, lower, node = [], -1, state
        while node >= 0:
            self._splay(node)
            before, cut = ends[node], below[node]
            if before >= 0:
                found.append((self.sizes[node], before))
            if cut >= 0:  # goes on as a segment of its own
                ends[cut] = before
            below[node] = lower
            lower, node = node, self.parent[node]
        self._splay(state)
        ends[state] = end
        return found


def runs_within(words: list, times: int = TIMES, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of `words` that are at least `times` periods (3 or more)
    and `least` words long."""
    links, sizes, prefixes = automaton(words)
    tree, last = LastEnds(links, sizes), {}
    for end, state in enumerate(prefixes):
        for size, before in tree.access(state, end):
            period = end - before
            # a suffix so long has no nearer like, unless a smaller number is its period
            if size >= (times - 1) * period and size + period >= least:
                last[end - period - size + 1, period] = end
    return sorted((start, end - start + 1, period) for (start, period), end in last.items())


def word_runs(words: list[bytes], times: int = TIMES, least: int = LEAST) -> list[tuple[int, int, int]]:
    """The runs of a text's words, by start, then period."""
    hashes = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    return [
        (start + at, length, period)
        for start, stop in candidates(hashes, times, least)
        for at, length, period in runs_within(words[start:stop], times, least)
    ]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run repeats: of each run its first period stays."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [words[n] for n in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]


def periodic_runs(docs: DataFrame, times: int = TIMES, least: int = LEAST) -> DataFrame:
    """(doc_id, n_words, runs, collapsed), one row per row of `docs(doc_id, text)`.

    Words are runs of other than ASCII white space in the whole text. `runs` are structs of start
    (word number from 0), length and period of at least `times` periods (3 or more) and `least`
    words, by start, then period; `collapsed` has the words that no run repeats, joined by one space.
    NULL and blank texts have no words. Other columns are ignored; an empty table gives no rows.
    """
    if times < 3:
        raise ValueError("runs of less than three periods are not told apart")
    kind = docs.schema["doc_id"].dataType.simpleString()
    run = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for first, stop in text_ranges(texts):
                sizes, found, kept = [], [], []
                for text in texts[first:stop]:
                    words = text.encode().split()
                    runs = word_runs(words, times, least)
                    sizes.append(len(words))
                    found.append([dict(zip(("start", "length", "period"), r)) for r in runs])
                    kept.append(b" ".join(collapsed(words, runs)).decode())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[first:stop], pa.array(sizes, pa.int64()),
                        pa.array(found, pa.list_(run)), pa.array(kept, pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        find,
        f"doc_id {kind}, n_words long,"
        " runs array<struct<start: long, length: long, period: long>>, collapsed string",
    )
