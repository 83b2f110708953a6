"""Linking fingerprints by Hamming distance with vantage-point trees.

The bits of a fingerprint are cut into blocks of equal width, and one vantage-point tree is built
over each block. Two fingerprints that differ in at most `radius` bits differ in at most
`radius // blocks` bits of some block, so a search of every tree with that smaller radius meets
every pair.

A tree node holds a vantage point and a distance: nearer fingerprints go to one side, the rest to
the other. The leaves are shards. A fingerprint lives in one leaf per tree and visits every leaf
that the triangle inequality does not rule out. Leaves are linked in parallel, with exact distances
over all bits. The tree is built from a sample of bounded size; every fingerprint is put into it.
Its depth follows the number of fingerprints, up to the bits of a block: with three blocks of 64
bits leaves keep their size up to 2,000 * 2**21 fingerprints, and grow with the data from there.

Within a leaf, vantage points prune again: what lies further than twice the radius from a vantage
point can't be near anything within the radius of it. A leaf yields one edge per linked
fingerprint, not one per pair. Leaves of more than `leaf_rows` rows are cut into chunks, and each
pair of chunks is one task's work, so that no task holds a leaf of unbounded size.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF_TARGET = 2_000
LEAF_ROWS = 60_000
SAMPLE_PER_LEAF = 16
MAX_SAMPLE = 1 << 20


def as_words(fingerprints, width: int) -> np.ndarray:
    """Binary fingerprints of `width` bits as a matrix of 64-bit words."""
    raw = b"".join(fingerprints)
    return np.frombuffer(raw, dtype=">u8").reshape(-1, width // 64).astype(np.uint64)


def block_values(words: np.ndarray, blocks: int, block: int) -> np.ndarray:
    """The bits of one block, as numbers. Blocks don't cross words when there are several words."""
    per_word = blocks // words.shape[1]
    word, part = divmod(block, per_word)
    low, high = part * 64 // per_word, (part + 1) * 64 // per_word
    return (words[:, word] >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)


def grow_tree(values: np.ndarray, depth: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Vantage points and distances of a full binary tree of `depth` levels, in heap order."""
    random = np.random.default_rng(seed)
    points = np.zeros((1 << depth) - 1, dtype=np.uint64)
    splits = np.zeros(len(points), dtype=np.int16)
    members = {0: values}
    for node in range(len(points)):
        here = members.pop(node)
        # of a few candidates, the point that halves its node best
        best = None
        for point in random.choice(here, 4) if len(here) else random.choice(values, 1):
            distance = np.bitwise_count(here ^ point) if len(here) else np.zeros(1, np.uint8)
            split = int(np.median(distance))
            if split and (distance <= split).mean() > 0.5 > (distance <= split - 1).mean():
                low, high = (distance <= split - 1).mean(), (distance <= split).mean()
                split -= int(0.5 - low < high - 0.5)
            uneven = abs((distance <= split).mean() - 0.5)
            if best is None or uneven < best[0]:
                best = uneven, point, split
        points[node], splits[node] = best[1], best[2]
        near = np.bitwise_count(here ^ points[node]) <= splits[node]
        members[2 * node + 1], members[2 * node + 2] = here[near], here[~near]
    return points, splits


def home_leaf(values: np.ndarray, points: np.ndarray, splits: np.ndarray) -> np.ndarray:
    node = np.zeros(len(values), dtype=np.int64)
    for _ in range(int(math.log2(len(points) + 1))):
        distance = np.bitwise_count(values ^ points[node]).astype(np.int16)
        node = 2 * node + 1 + (distance > splits[node])
    return node - len(points)


def leaves(values: np.ndarray, points: np.ndarray, splits: np.ndarray, radius: int):
    """(row, leaf) for every leaf that may hold something within `radius` of the row's value."""
    row, node = np.arange(len(values)), np.zeros(len(values), dtype=np.int64)
    for _ in range(int(math.log2(len(points) + 1))):
        distance = np.bitwise_count(values[row] ^ points[node]).astype(np.int16)
        inner = distance - radius <= splits[node]
        outer = distance + radius > splits[node]
        row = np.concatenate([row[inner], row[outer]])
        node = np.concatenate([2 * node[inner] + 1, 2 * node[outer] + 2])
    return row, node - len(points)


def near_stars(words: np.ndarray, lives: np.ndarray, radius: int) -> np.ndarray:
    """A label per row: rows with one label are linked within `radius` through this leaf's rows.

    Every row that lives here serves as a vantage point or lies within `radius` of one. Rows within
    `radius` of it and rows up to twice as far are compared, then the former are finished.
    """
    kind = np.uint8 if words.shape[1] < 4 else np.uint16
    columns = [np.ascontiguousarray(c) for c in words.T]

    def distances(columns: list[np.ndarray], point: int) -> np.ndarray:
        out = np.bitwise_count(columns[0] ^ words[point, 0]).astype(kind)
        for column, value in zip(columns[1:], words[point, 1:]):
            out += np.bitwise_count(column ^ value)
        return out

    label = np.arange(len(words))
    finished = np.zeros(len(words), dtype=bool)
    active, left = label.copy(), len(words)
    for point in np.flatnonzero(lives):
        if finished[point]:
            continue
        distance = distances(columns, point)
        near = active[distance <= radius]
        near = near[~finished[near]]
        if len(near) > 1:
            fringe = np.flatnonzero((distance > radius) & (distance <= 2 * radius))
            fringe = active[fringe]
            fringe = fringe[~finished[fringe]]
            hit = np.zeros(len(fringe), dtype=bool)
            for at in near:
                rest = np.flatnonzero(~hit)
                if not len(rest):
                    break
                hit[rest[distances(list(words[fringe[rest]].T), at) <= radius]] = True
            linked = np.concatenate([near, fringe[hit]])
            old = np.unique(label[linked])
            if len(old) > 1:
                label[np.isin(label, old)] = old[0]
        finished[near] = True
        left -= len(near)
        if left < 0.9 * len(active):  # finished rows are passed over, and now and then put away
            active = active[~finished[active]]
            columns = [np.ascontiguousarray(c) for c in words[active].T]
    return label


def _assigned(prints: DataFrame, trees: list, width: int, block_radius: int) -> DataFrame:
    """(tree, leaf, lives, fp): the leaf a fingerprint lives in, and the later ones it visits."""
    shared = prints.sparkSession.sparkContext.broadcast(trees)

    def assign(batches):
        forest = shared.value
        for batch in batches:
            raw = batch["fp"].to_numpy()
            words = as_words(raw, width)
            for tree, (points, splits) in enumerate(forest):
                values = block_values(words, len(forest), tree)
                home = home_leaf(values, points, splits)
                row, leaf = leaves(values, points, splits, block_radius)
                # of two leaves that a pair could meet in, the later one is enough
                keep = leaf >= home[row]
                row, leaf = row[keep], leaf[keep]
                yield pd.DataFrame(
                    {"tree": tree, "leaf": leaf, "lives": leaf == home[row], "fp": raw[row]}
                )

    return prints.select("fp").mapInPandas(
        assign, "tree int, leaf long, lives boolean, fp binary"
    )


def tree_depth(total: int, bits: int, leaf_target: int = LEAF_TARGET) -> int:
    """Levels that leave about `leaf_target` of `total` fingerprints in a leaf, at most one a bit."""
    return max(0, min(bits, math.ceil(math.log2(max(1, total) / leaf_target))))


def near_edges(
    prints: DataFrame,
    width: int,
    radius: int,
    blocks: int,
    leaf_target: int = LEAF_TARGET,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """Edges (a, b) that connect all distinct binary fingerprints of `prints(fp)` differing in at
    most `radius` of `width` bits, directly or through others so linked.

    `prints` must hold distinct, non-null values and be cheap to read again. An empty table gives
    no edges.
    """
    total = prints.count()
    depth = tree_depth(total, width // blocks, leaf_target)
    wanted = min(MAX_SAMPLE, SAMPLE_PER_LEAF << depth)
    # about `wanted` values, chosen by hash: the same ones on every run
    step = max(1, total // wanted)
    chosen = prints.where(F.pmod(F.xxhash64("fp"), F.lit(step)) == 0)
    sample = chosen.toArrow()["fp"].to_pylist()
    words = as_words(sorted(sample), width) if sample else np.zeros((1, width // 64), np.uint64)
    trees = [grow_tree(block_values(words, blocks, b), depth, b) for b in range(blocks)]

    rows = _assigned(prints, trees, width, radius // blocks)
    large = (
        rows.groupBy("tree", "leaf").count().where(F.col("count") > leaf_rows)
        .select("tree", "leaf", F.ceil(F.col("count") / (leaf_rows // 2)).cast("int").alias("chunks"))
    )
    chunk = F.pmod(F.xxhash64("fp"), F.coalesce("chunks", F.lit(1))).cast("int")
    work = (
        rows.join(large, ["tree", "leaf"], "left")
        .withColumn("own", chunk)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)))
        .select(
            "tree", "leaf", "lives", "fp",
            F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        )
    )

    def link(part: pd.DataFrame) -> pd.DataFrame:
        raw = part["fp"].to_numpy()
        label = near_stars(as_words(raw, width), part["lives"].to_numpy(dtype=bool), radius)
        member = np.flatnonzero(label != np.arange(len(label)))
        return pd.DataFrame({"a": raw[member], "b": raw[label[member]]})

    return work.groupBy("tree", "leaf", "i", "j").applyInPandas(link, "a binary, b binary")
