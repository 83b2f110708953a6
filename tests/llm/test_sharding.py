import zlib
from collections import Counter, defaultdict

import pytest

from martloom.llm import queries, sharding

SF_DIR = "/root/testdata/sf0.01"


def totals(owners, loads):
    out = Counter()
    for slot, owner in enumerate(owners):
        out[owner] += loads[slot]
    return out


@pytest.mark.parametrize("power", [0, 1, 3])
def test_rebalancing_evens_out(power):
    loads = [((s * 7919) % 97) ** power for s in range(4096)]
    before = sharding.first_map(4096, 16)
    after = sharding.rebalanced(before, loads, 16)
    sums = totals(after, loads)
    assert max(sums.values()) - min(sums.values()) <= max(loads)
    assert len(after) == 4096 and set(after) == set(range(16))


def test_growth_moves_slots_into_the_new_shard_only():
    loads = [((s * 7919) % 97) + 1 for s in range(4096)]
    before = sharding.rebalanced(sharding.first_map(4096, 16), loads, 16)
    after = sharding.grown(before, loads, 16)
    assert all(a in (b, 16) for a, b in zip(after, before))
    sums = totals(after, loads)
    assert max(sums.values()) - min(sums.values()) <= 0.02 * sums[16]


def test_growth_of_empty_and_lumpy_maps():
    assert sharding.grown([0, 1], [0, 0], 2) == [0, 1]
    after = sharding.grown([0, 0, 0, 1], [100, 2, 3, 1], 2)
    assert after[0] == 0 and set(after[1:3]) <= {0, 2}


def test_versions_are_kept(spark):
    store = sharding.SlotMap(spark)
    store.store(1, [0, 1, 0, 1])
    store.store(2, [0, 1, 1, 1])
    assert store.owners(1) == [0, 1, 0, 1] and store.owners(2) == [0, 1, 1, 1]


def test_query_against_its_definition(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.op6_sharding(spark, SF_DIR).collect()
    assert {r.doc_id for r in rows} == set(docs) and len(rows) == len(docs)
    places, sizes = defaultdict(list), Counter()
    for r in rows:
        data = docs[r.doc_id].encode()
        assert (r["size"], r.text_crc32) == (len(data) + 1, zlib.crc32(data))
        assert r.law == "bytes" and r.grown_shard is None
        places[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(sizes.values()) - min(sizes.values()) < 0.01 * sum(sizes.values()) / 16


def test_odd_rows(docs):
    table = docs((None, None), (None, None), (1, ""), (2, "x" * 300_000), (2, "é"))
    got = sharding.shard_positions(table, 3).collect()
    assert sorted(r["size"] for r in got) == [1, 1, 1, 3, 300_001]
    assert len({(r.shard, r.slot) for r in got}) == 5
    kept = sharding.with_shards(table.withColumnRenamed("extra", "shard"), 3)
    assert kept.count() == 5 and kept.columns.count("shard") == 1
    assert sharding.shard_positions(docs(), 3).count() == 0


def test_a_third_of_all_rows_alike_keeps_the_law(docs):
    rows = [(7, "the very same row")] * 400 + [(1000 + i, f"another row {i}") for i in range(800)]
    got = sharding.shard_positions(docs(*rows), 16).toPandas()
    sizes = got.groupby("shard")["size"].sum()
    assert len(got) == 1200 and len(sizes) == 16
    assert sizes.max() - sizes.min() <= max(got.groupby("virtual_slot")["size"].sum())
    assert sizes.max() < 1.1 * sizes.mean()
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
