"""A Merkle manifest of a dataset: one tree per group of rows, one tree over the groups.

A node is (tree, left, pos, digest): its tree, the number of nodes at its level, its place there
from 0. While a tree has more than one node, each `fanout` consecutive ones become their parent, the
SHA-256 of their digests (lower-case hex, put together in order). What is left is the tree's top.

Every level joins itself: the first node of a run (slot 0) computes the places of its siblings, finds
them by an equijoin and emits the parent. A run has at most `fanout` nodes, so a tree that holds a
third of all rows is as evenly spread as many small ones. From the top down each node then gets its
path: for every level the digests that stand before and after it, which prove that its leaf is in
the manifest. Paths are kept per run, a sixteenth of the leaves, and joined to the leaves last. All
levels are written as they come, so a lost executor repeats one level at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.keys import assign_keys
from martloom.shared import written

FANOUT = 16
_STEP = "struct<before: string, after: string>"


def field(value: Column) -> Column:
    """`-` for NULL, else the UTF-8 bytes of the value as text, `:` and the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def sibling_runs(nodes: DataFrame, fanout: int) -> DataFrame:
    """(tree, run, left, digests): the nodes of each run in order, by a self-join of
    `nodes(tree, left, pos, digest)`, in which every tree has more than one node."""
    first = nodes.where(F.pmod("pos", F.lit(fanout)) == 0)
    with_others = first.where("pos + 1 < left")
    if fanout == 2:
        other = F.col("pos").bitwiseXOR(F.lit(1).cast("long"))
    else:
        last = F.least(F.col("pos") + fanout, F.col("left")) - 1
        other = F.explode(F.sequence(F.col("pos") + 1, last))
    wanted = with_others.select("tree", other.alias("pos"))
    siblings = nodes.join(wanted, ["tree", "pos"]).select(*nodes.columns)
    return (
        first.unionByName(siblings)
        .groupBy("tree", F.floor(F.col("pos") / fanout).alias("run"), "left")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "digest"))).alias("nodes"))
        .select("tree", "run", "left", F.col("nodes.digest").alias("digests"))
    )


def levels(nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """The runs of each level, lowest first, and the trees (tree, top) that are done at each level,
    of which there is one more. `nodes` must be cheap to read again."""
    nodes = nodes.select("tree", "left", "pos", "digest")
    most = nodes.agg(F.max("left")).first()[0] or 0
    runs, done = [], []
    while True:
        done.append(nodes.where("left = 1").select("tree", F.col("digest").alias("top")))
        if most <= 1:
            return runs, done
        runs.append(written(sibling_runs(nodes.where("left > 1"), fanout), "runs"))
        nodes = runs[-1].select(
            "tree", F.ceil(F.col("left") / fanout).alias("left"), F.col("run").alias("pos"),
            F.sha2(F.array_join("digests", ""), 256).alias("digest"),
        )
        most = -(-most // fanout)


def _step(slot: Column) -> Column:
    """The path of the node in `slot` of a run with `digests` whose parent has `path`."""
    size = F.size("digests")
    before, after = F.slice("digests", F.lit(1), slot), F.slice("digests", slot + 2, size)
    own = F.struct(
        F.array_join(before, "").alias("before"), F.array_join(after, "").alias("after")
    )
    return F.concat(F.array(own), "path")


def run_paths(runs: list[DataFrame], tops: list[DataFrame], fanout: int) -> DataFrame | None:
    """(tree, run, digests, top, path) of the lowest runs; path is that of their parents. `tops` are
    the trees (tree, top, path) done at each level. None if no tree has runs."""
    if not runs:
        return None

    def as_nodes(trees: DataFrame) -> DataFrame:
        return trees.select("tree", F.lit(0).cast("long").alias("pos"), "top", "path")

    above = as_nodes(tops[-1])
    for level in reversed(range(len(runs))):
        up = above.withColumnRenamed("pos", "run")
        here = runs[level].join(up, ["tree", "run"]).select("tree", "run", "digests", "top", "path")
        here = written(here, "paths")
        if level:
            slots = F.explode(F.sequence(F.lit(0), F.size("digests") - 1))
            members = here.select("*", slots.alias("slot")).select(
                "tree", (F.col("run") * fanout + F.col("slot")).alias("pos"), "top",
                _step(F.col("slot")).alias("path"),
            )
            above = members.unionByName(as_nodes(tops[level]))
    return here


def fold(digest: Column, path: Column) -> Column:
    """The top to which a leaf's digest and its path lead."""
    return F.aggregate(
        path, digest, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256)
    )


def proof(path: Column) -> Column:
    """All siblings from the leaf up, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def _placed(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """`rows` with their group's number `tree` (ascending, from 0, NULL first), their place `pos` in
    it by `order`, and its size `left`. Rows that are equal in all of these may hold a third of the
    table: a mark of their own deals them to several tasks."""
    marked = rows.withColumn("mark", F.monotonically_increasing_id())
    numbered = assign_keys(marked, [group, *order, "mark"], "number", key_type="long")
    sizes = numbered.groupBy(group).agg(F.min("number").alias("first"), F.count("*").alias("left"))
    groups = assign_keys(sizes, [group], "tree", key_type="long").withColumnRenamed(group, "named")
    return numbered.join(groups, F.col(group).eqNullSafe(F.col("named"))).select(
        *rows.columns, (F.col("tree") - 1).alias("tree"),
        (F.col("number") - F.col("first")).alias("pos"), "left",
    )


def manifest(leaves: DataFrame, fanout: int = FANOUT) -> tuple[DataFrame, str | None]:
    """Every row of `leaves(grouped, id, digest, ...)` with `top`, the top of its group's tree, and
    `path`; and the root, the top of the tree over the groups, None for an empty table.

    Leaves ascend by id (NULL first, then by digest) in their group, groups by value (NULL first,
    by bytes). Repeated rows are leaves of their own. Other columns of `leaves` stay, but for the
    names tree, pos, left, top, path, mark, number, first and named, which must be free.
    """
    placed = written(_placed(leaves, "grouped", ["id", "digest"]), "leaves")
    runs, done = levels(placed, fanout)
    tops = written(_together(done), "tops")
    groups = tops.count()
    nodes = tops.select(
        F.lit(0).cast("long").alias("tree"), F.lit(groups).cast("long").alias("left"),
        F.col("tree").alias("pos"), F.col("top").alias("digest"),
    )
    group_runs, group_done = levels(nodes, fanout)
    root = group_done[-1].first()
    empty = F.array().cast(f"array<{_STEP}>")
    above = run_paths(group_runs, [d.withColumn("path", empty) for d in group_done], fanout)

    def with_path(trees: DataFrame) -> DataFrame:
        """Trees (tree, top) or leaves alone in theirs, with the way from there to the root."""
        if above is None:
            return trees.withColumn("path", empty)
        upper = above.select(F.col("run").alias("group_run"), "digests", "path")
        joined = trees.join(upper, F.floor(F.col("tree") / fanout) == F.col("group_run"))
        slot = F.pmod("tree", F.lit(fanout)).cast("int")
        return joined.select(*trees.columns, _step(slot).alias("path"))

    columns = [*placed.columns, "top", "path"]
    alone = with_path(placed.where("left = 1").withColumn("top", F.col("digest")))
    lowest = run_paths(runs, [with_path(d) for d in done], fanout)
    if lowest is None:
        return alone.select(*columns), root and root.top
    keyed = placed.where("left > 1").withColumn("run", F.floor(F.col("pos") / fanout))
    slot = F.pmod("pos", F.lit(fanout)).cast("int")
    others = keyed.join(lowest, ["tree", "run"]).select(
        *placed.columns, "top", _step(slot).alias("path")
    )
    return others.unionByName(alone.select(*columns)), root and root.top


def _together(tables: Sequence[DataFrame]) -> DataFrame:
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out
