import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from martloom.llm import queries, simhash, vptree
from martloom.llm.components import components

SF_DIR = "/root/testdata/sf0.01"


def plain_simhash(text, n):
    """The definition, bit by bit."""
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [words[i : i + n] for i in range(len(words) - n + 1)] or [words]
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles]
    return sum(
        1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)
    )


def plain_groups(prints, radius):
    """Index of the first member of each print's group, all pairs compared."""
    first = list(range(len(prints)))

    def find(x):
        while first[x] != x:
            x = first[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                x, y = sorted((find(i), find(j)))
                first[y] = x
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize(
    "text",
    [None, "", " \t\n", "One", "one two three", "a b c d", "A b C d e f g ÄÖ äö " * 3, "x " * 70_000],
)
def test_fingerprint_is_its_definition(text):
    assert int.from_bytes(simhash.simhash(text, 4), "big") == plain_simhash(text, 4)


def test_hash_equals_the_engines(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0]
    assert got % 2**64 == xxhash.xxh64_intdigest(b"a b c d", 42)


def clustered(seed, count):
    random = np.random.default_rng(seed)
    out = set()
    for centre in random.integers(0, 2**64, count // 8, dtype=np.uint64).tolist():
        at = centre
        for _ in range(8):  # a walk, so that groups are chains
            out.add(at)
            for bit in random.integers(0, 64, random.integers(1, 7)).tolist():
                at ^= 1 << bit
    return sorted(out | {0, 1, 0b111, 2**64 - 1})


@pytest.mark.parametrize("leaf_target, leaf_rows", [(2000, 60_000), (30, 60_000), (30, 40)])
def test_trees_lose_no_link(spark, leaf_target, leaf_rows):
    prints = clustered(7, 1500)
    table = spark.createDataFrame([(bytearray(p.to_bytes(8, "big")),) for p in prints], "fp binary")
    edges = vptree.near_edges(table, 64, 4, 3, leaf_target=leaf_target, leaf_rows=leaf_rows)
    got = {
        int.from_bytes(r.node, "big"): int.from_bytes(r.root, "big")
        for r in components(edges).collect()
    }
    expected = plain_groups(prints, 4)
    assert {p: got.get(p, p) for p in prints} == {p: prints[e] for p, e in zip(prints, expected)}


def test_depth_follows_the_number_of_fingerprints():
    assert [vptree.tree_depth(n, 21) for n in (0, 1, 2_000, 4_000, 2_000 << 17)] == [0, 0, 0, 1, 17]
    assert vptree.tree_depth(2_000 << 30, 21) == 21


def test_one_dense_group_is_one_star_per_leaf():
    random = np.random.default_rng(5)
    words = np.zeros((3000, 1), dtype=np.uint64)
    words[1:, 0] = random.integers(0, 64, 2999).astype(np.uint64)
    assert len(set(vptree.near_stars(words, np.ones(3000, dtype=bool), 4).tolist())) == 1


def test_components_of_chains_stars_and_loops(rows):
    edges = [(i, i + 1) for i in range(100, 180)] + [(7, i) for i in range(20, 60)]
    edges += [(5, 5), (7, 20), (20, 7), (200, 60), (60, 7)]
    got = {tuple(r) for r in components(rows(edges, "a long, b long")).collect()}
    chain = {(i, 100) for i in range(100, 181)}
    star = {(i, 7) for i in [7, *range(20, 61), 200]}
    assert got == chain | star
    assert components(rows([], "a long, b long")).count() == 0


def test_groups_of_odd_rows(docs):
    table = docs(
        (9, None), (4, ""), (7, "a b c d e"), (3, "A b c d  e"), (None, "a b c d e"), (3, "A b c d  e"),
        (12, "quite another text of words"), (None, "only nulls here in this group"),
    )
    got = sorted(
        simhash.near_groups(table, 4, 4, 3).select("doc_id", "component_id").collect(), key=repr
    )
    assert got == sorted(
        [(9, 4), (4, 4), (7, 3), (3, 3), (None, 3), (3, 3), (12, 12), (None, None)], key=repr
    )
    assert simhash.near_groups(docs(), 4, 4, 3).count() == 0


def test_one_document_of_each_group_stays(docs):
    table = docs(
        (5, "one two three four five six", "en", "s", 1, "x"), (None, "one two three four five six"),
        (2, "One two three four five six"), (2, "One two three four five six"), (8, None), (9, " "),
        (1, "something else entirely"),
    )
    table = table.withColumns({c: table.n_chars for c in ("k1", "K2", "_k1", "fp", "least", "a b.c")})
    got = simhash.deduplicated(table, 4, 4, 3)
    assert got.columns == table.columns
    assert sorted(r.doc_id for r in got.collect()) == [1, 2, 8]
    assert simhash.deduplicated(docs(), 4, 4, 3).count() == 0


def test_a_third_of_all_rows_alike(spark, docs):
    copies = [(i % 7, "the very same text in many rows") for i in range(300)]
    others = [(100 + i, " ".join(f"w{i}x{j}" for j in range(40))) for i in range(600)]
    kept = simhash.deduplicated(docs(*copies, *others), 4, 4, 3)
    assert sorted(r.doc_id for r in kept.collect()) == [0, *range(100, 700)]


def test_query_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    prints = [plain_simhash(r.text, 4) for r in table]
    expected = [
        (r.doc_id, f"{p:016x}", table[e].doc_id)
        for r, p, e in zip(table, prints, plain_groups(prints, 4))
    ]
    got = queries.op9_near_groups(spark, SF_DIR).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == expected
