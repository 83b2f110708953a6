from collections import Counter

import duckdb
import pytest

import corpus_pipeline as P
from compare import differences
from martloom.llm import queries
from test_simhash import plain_groups, plain_simhash

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before and after each stage."""
    out, docs = {}, spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out["documents"] = docs.toPandas()
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        out[name] = docs.toPandas()
    return out


def test_stages_keep_the_columns_of_documents(stages):
    names = ["documents", *[n for n, _ in P.STAGES]]
    assert names[1:] == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]
    for name in names[1:-1]:
        assert list(stages[name].columns) == list(stages["documents"].columns)


def test_toxic_documents_go_and_others_stay(spark, stages):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").toPandas()
    kept = set(stages["toxicity"].doc_id)
    assert labels[labels.toxic == 0].doc_id.isin(kept).mean() > 0.98
    # a few documents of repeated plain words are labelled toxic, too
    assert labels[labels.toxic == 1].doc_id.isin(kept).mean() < 0.1


def test_near_duplicates_by_brute_force(stages):
    """The smallest id of each group of fingerprints linked within four bits, all pairs compared."""
    before = stages["toxicity"].sort_values("doc_id")
    prints = [plain_simhash(t, 4) for t in before.text]
    ids = before.doc_id.tolist()
    expected = {ids[first] for first in plain_groups(prints, 4)}
    assert 1 < len(expected) < len(ids)
    assert sorted(stages["near_dedup"].doc_id) == sorted(expected)


def test_contaminated_documents_go(spark, stages):
    con = duckdb.connect()
    con.register("documents", stages["near_dedup"])
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM read_parquet('{SF_DIR}/benchmark.parquet')")
    clean = con.execute(f"SELECT doc_id FROM ({queries.OP4_SQL}) WHERE NOT contaminated").fetchall()
    assert sorted(stages["decontamination"].doc_id) == sorted(r[0] for r in clean)


def test_mixing_as_the_sql_says(stages):
    con = duckdb.connect()
    con.register("documents", stages["decontamination"])
    sql = f"SELECT doc_id, (taken / size)::BIGINT FROM ({queries.OP7_SQL}) WHERE taken > 0"
    assert dict(con.execute(sql).fetchall()) == dict(Counter(stages["mixing"].doc_id))


def test_every_row_gets_a_shard(stages):
    mixed, sharded = stages["mixing"], stages["sharding"]
    assert Counter(mixed.doc_id) == Counter(sharded.doc_id)
    sizes = sharded.groupby("shard")["size"].sum()
    assert set(sizes.index) <= set(range(P.SHARDS))
    assert sizes.max() - sizes.min() <= max(sharded.groupby("virtual_slot")["size"].sum())


def test_run_is_the_stages_in_turn(spark, stages):
    got = P.run(spark, SF_DIR).toPandas()
    assert sorted(zip(got.doc_id, got.shard)) == sorted(
        zip(stages["sharding"].doc_id, stages["sharding"].shard)
    )


def test_stages_on_odd_rows(spark, docs, tmp_path):
    table = docs((1, None), (1, None), (None, ""), (None, "a b"), (2, "x " * 50_000, "en", None), (3, "a b", None, "s"))
    for name, stage in P.STAGES:
        if name != "toxicity":
            table = stage(spark, table, SF_DIR)
    assert "extra" in table.columns
    assert {r.text for r in table.select("text").collect() if r.text} <= {"a b", "x " * 50_000}
    empty = docs()
    for _, stage in P.STAGES:
        empty = stage(spark, empty, SF_DIR)
        assert empty.count() == 0


@pytest.mark.parametrize("name", [n for n, (_, sql) in queries.CHECKS.items() if sql])
def test_query_equals_sql(spark, name):
    query, sql = queries.CHECKS[name]
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    result = con.execute(sql)
    cols = [d[0] for d in result.description]
    df = query(spark, SF_DIR)
    assert differences([tuple(r) for r in df.collect()], df.columns, result.fetchall(), cols) is None
    if name in ("op7_mixing", "op8_lines"):
        assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
