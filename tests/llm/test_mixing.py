import pytest
from pyspark.sql import functions as F

from martloom.llm import mixing


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        given = {s: target[s] + left * weight[s] / total for s in open_}
        left = 0.0
        for s in list(open_):
            if given[s] > most * sizes[s]:
                left += given[s] - most * sizes[s]
                given[s] = most * sizes[s]
                open_.discard(s)
            target[s] = given[s]
    return target


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1, "b": 5000, "c": 3, None: 70, "Z": 20, "é": 400},
        {"a": 10},
        {None: 7, "a": 0},
        {"a": 0, "b": 0},
        {f"s{i}": (i * 37) % 101 for i in range(25)},
    ],
)
def test_targets_share_the_excess(rows, sizes):
    sized = rows([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(sized).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_word_count(docs):
    table = docs((1, None), (2, ""), (3, " a\tb\x0bc\nd\r\x0c e f "), (4, "x"))
    got = table.select("doc_id", mixing.word_count(F.col("text")).alias("n")).collect()
    assert [r.n for r in sorted(got)] == [0, 0, 5, 1]


def test_taken_words_come_near_the_targets(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.lit("w "), (F.col("id") % 17).cast("int")).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("source"),
    )
    got = mixing.mixed_sizes(docs).toPandas()
    assert len(got) == 6000 and (got.times <= 2).all()
    for _, part in got.groupby("source", dropna=False):
        assert abs((part.times * part["size"]).sum() - part.target.iloc[0]) <= 16
    again = mixing.mixed_sizes(docs.repartition(5)).toPandas()
    assert sorted(zip(got.doc_id, got.times)) == sorted(zip(again.doc_id, again.times))
    taken = mixing.mixed(docs)
    assert taken.columns == docs.columns
    assert taken.groupBy("doc_id").count().toPandas().set_index("doc_id")["count"].to_dict() == {
        d: t for d, t in zip(got.doc_id, got.times) if t
    }


def test_smaller_budgets_are_subsets(spark):
    docs = spark.range(2000).select(
        F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), (F.col("id") % 2).cast("string").alias("source")
    )
    few = {r.doc_id for r in mixing.mixed_sizes(docs, (1,), 0.3).where("times > 0").collect()}
    more = {r.doc_id for r in mixing.mixed_sizes(docs, (1,), 0.6).where("times > 0").collect()}
    assert few < more


def test_odd_rows(docs):
    table = docs((1, None), (None, "a b", "en", "s"), (None, "a b", "en", "s"), (2, "", "en", None), (3, "c", "en", "t"))
    got = mixing.mixed_sizes(table.withColumnRenamed("extra", "hash")).toPandas()
    assert len(got) == 5
    assert got[got.source == "s"].times.nunique() == 1
    assert mixing.mixed_sizes(docs()).count() == 0 and mixing.mixed(docs()).count() == 0


def test_columns_of_any_name_stay(docs):
    table = docs(*[(i, "a few words", None, f"s{i % 3}") for i in range(90)])
    names = ("threshold", "repeats", "of", "_hash", "hashed", "again", "target", "a.b")
    table = table.withColumns({c: F.lit(c) for c in names})
    got = mixing.mixed(table)
    assert got.columns == table.columns
    rows = got.collect()
    assert len(rows) > 90 and all(r[c] == c for r in rows for c in names)
