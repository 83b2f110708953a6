"""Operators that learn from labels: held-out accuracy, and rows that tell nothing."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.llm import langmix, quality, queries, toxicity

SF_DIR = "/root/testdata/sf0.01"


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def test_language_of_held_out_documents(spark):
    got = queries.op1_language(spark, SF_DIR).join(
        table(spark, "documents").select("doc_id", "lang"), "doc_id"
    ).toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all()
    held = got[got.held_out]
    assert 250 < len(held) < 420
    assert (held.lang == held.lang_pred).mean() > 0.97


def test_mixture_finds_both_languages(spark):
    known = table(spark, "documents")
    longest = known.groupBy("lang").agg(F.max_by("text", F.length("text")).alias("text"))
    texts = {r.lang: r.text for r in longest.collect()}
    mix = texts["de"][:3000] + "\n" + texts["es"][:1000]
    docs = spark.createDataFrame([(1, mix), (2, texts["fr"])], "doc_id long, text string")
    both, one = langmix.languages(docs, known).orderBy("doc_id").collect()
    assert set(both.langs) == {"de", "es"} and both.lang_pred == "de"
    assert sum(both.shares) == pytest.approx(1) and 0.5 < both.score < 0.95
    assert list(one.langs) == ["fr"] and one.score == 1


def test_language_of_odd_rows(spark, docs):
    known = docs((1, "the cat and the dog", "en"), (2, None, "en"), (3, "le chat et le chien", "fr"), (4, "x", None))
    table = docs((1, None), (1, None), (2, ""), (3, "123 ..."), (None, "the the"), (5, "chat " * 100_000))
    got = langmix.languages(table.withColumnRenamed("lang", "score"), known).collect()
    assert sorted(r.lang_pred for r in got) == ["en", "fr", "und", "und", "und", "und"]
    assert all(r.score == 0 for r in got if r.lang_pred == "und")
    assert langmix.languages(table, docs()).where("lang_pred <> 'und'").count() == 0
    assert langmix.languages(docs(), known).count() == 0


def test_letters():
    assert langmix.has_letters("1 é") and langmix.has_letters("字")
    assert not any(langmix.has_letters(t) for t in (None, "", "12 _ ½ ² ٣ !?"))


def test_shares_maximise_the_likelihood():
    random = np.random.default_rng(2)
    chance = random.dirichlet(np.ones(50), 3).T
    counts = random.multinomial(20_000, chance @ [0.6, 0.3, 0.1])
    pi, _ = langmix.shares(counts.astype(float), chance, rounds=200)
    assert pi == pytest.approx([0.6, 0.3, 0.1], abs=0.03)


def test_toxicity_of_held_out_documents(spark):
    got = queries.op10_toxicity(spark, SF_DIR).join(table(spark, "labels"), "doc_id").toPandas()
    assert queries.op10_toxicity(spark, SF_DIR).count() == 1000
    held = got[got.held_out]
    assert (held.predicted == held.toxic).mean() > 0.95
    assert (got.predicted == (got.score >= 0.5)).all() and got.score.between(0, 1).all()


@pytest.fixture
def insults(docs):
    random = np.random.default_rng(4)
    words = ["".join(map(chr, random.integers(97, 123, 5))) for _ in range(60)]

    def sentence():
        return " ".join(random.choice(words, 6)) + "."

    out = []
    for i in range(400):
        parts = [sentence() for _ in range(8)]
        if i % 4 == 0:
            parts[i % 8] = f"you vile{words[i % 60]} thing."
        out.append((i, " ".join(parts)))
    return docs(*out)


def test_toxicity_finds_the_sentence(spark, insults):
    labels = insults.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    model = toxicity.fit(toxicity.labelled_sample(insults, labels.where("doc_id < 300")))
    judged = toxicity.with_toxicity(insults.where("doc_id >= 300"), model)
    rows = judged.select("doc_id", "toxicity.*").collect()
    assert all(r.predicted == (r.doc_id % 4 == 0) for r in rows)
    assert all("vile" in r.worst for r in rows if r.predicted)


def test_toxicity_sample_is_bounded_and_one_label_an_id(spark, insults, rows):
    labels = rows([(i, i % 2) for i in range(400)] * 2 + [(None, 1), (3, None)], "doc_id long, toxic int")
    sample = toxicity.labelled_sample(insults, labels, most=50).groupBy("toxic").count().collect()
    assert {tuple(r) for r in sample} == {(0, 50), (1, 50)}
    mixed = toxicity.labelled_sample(insults, rows([(1, 0), (1, 1)], "doc_id long, toxic int"))
    assert [r.toxic for r in mixed.collect()] == [1]


def test_toxicity_of_odd_rows(spark, docs, rows, insults):
    labels = insults.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    model = toxicity.fit(toxicity.labelled_sample(insults, labels))
    odd = docs((1, None), (None, ""), (2, "..!"), (2, "..!"), (3, "fine words " * 50_000))
    got = toxicity.with_toxicity(odd.withColumnRenamed("extra", "toxicity"), model)
    assert [r.toxicity.score for r in got.orderBy(F.length("text")).collect()][:4] == [0, 0, 0, 0]
    for few in ([], [(1, 0), (2, 0)]):
        assert toxicity.fit(toxicity.labelled_sample(insults, rows(few, "doc_id long, toxic int"))) is None
    assert toxicity.with_toxicity(odd, None).where("toxicity.predicted = 1").count() == 0
    assert toxicity.with_toxicity(docs(), model).count() == 0


def test_quality_of_labelled_documents(spark):
    got = queries.op2_quality(spark, SF_DIR)
    assert got.count() == 1000
    rows = got.join(table(spark, "labels"), "doc_id").toPandas()
    assert (rows.keep == (rows.quality == 1)).mean() > 0.97


def test_quality_shrinks_sparse_sites(rows):
    good, bad = "Plain words in a row, and some more of them.", "### $$$ *** %%% ###"
    data = [(i, good if i % 10 < 9 else bad, "big", "p") for i in range(300)]
    data += [(300 + i, bad, "spam", f"q{i % 2}") for i in range(100)]
    data += [(400, bad, "tiny", "r"), (401, good, None, None), (401, good, None, None), (402, None, "tiny", None)]
    table = rows(data, "doc_id long, text string, host string, path string")
    labels = rows([(i, int(i % 10 < 9)) for i in range(300)], "doc_id long, quality int")
    found = quality.site_quality(table, labels, F.col("host"), F.col("path")).toPandas()
    assert len(found) == len(data)
    by = found.groupby("host").path_mean.mean()
    assert by["spam"] < by["tiny"] < by["big"]
    assert found[found.host.isna()].score.nunique() == 1
    empty = table.where("doc_id < 0")
    assert quality.site_quality(empty, labels, F.col("host"), F.col("path")).count() == 0
    unlabelled = quality.site_quality(table, labels.where("doc_id < 0"), F.col("host"), F.col("path"))
    assert unlabelled.where("evidence <> 0.5").count() == 0


def test_one_id_in_a_third_of_all_rows_is_one_row_of_the_sample(spark, rows):
    texts = [(7, f"row {i} of the same id") for i in range(300)]
    texts += [(100 + i, f"text number {i}") for i in range(600)]
    table = rows(texts, "doc_id long, text string")
    labels = rows([(7, 1, 1), *[(100 + i, i % 2, i % 2) for i in range(100)]], "doc_id long, toxic int, quality int")
    sample = toxicity.labelled_sample(table, labels).collect()
    assert len(sample) == 101 and sum(r.text.startswith("row") for r in sample) == 1
    again = toxicity.labelled_sample(table.repartition(7), labels).collect()
    assert sorted(again) == sorted(sample)
    measured = table.withColumns(quality.features(F.col("text")))
    assert quality.fit(measured, labels) is not None


def test_noisy_or_of_given_weights():
    """A document's score by the definition, sentence by sentence."""
    random = np.random.default_rng(8)
    model = toxicity.Model(random.normal(0, 0.3, 1 << toxicity.BITS).astype(np.float32), -2.0)
    text = "One plain sentence.\nAnother, longer one! And a third?\n...\nthe end"
    starts, scores = toxicity.sentence_scores(text, model)
    clean = 1.0
    for score in scores:
        clean *= 1 - score
    assert len(scores) == len(starts) > 1
    assert toxicity.noisy_or(scores) == pytest.approx(1 - clean)


def test_shares_are_the_steps_of_the_definition():
    random = np.random.default_rng(9)
    chance = random.dirichlet(np.ones(12), 3).T
    counts = random.integers(0, 9, 12).astype(float)
    pi = [1 / 3] * 3
    for _ in range(5):
        new = [0.0] * 3
        for n, row in zip(counts, chance):
            whole = sum(p * c for p, c in zip(pi, row))
            for k in range(3):
                new[k] += n * pi[k] * row[k] / whole
        pi = [v / sum(new) for v in new]
    got, likelihood = langmix.shares(counts, chance, rounds=5)
    assert got == pytest.approx(pi)
    expected = sum(n * np.log(sum(p * c for p, c in zip(pi, row))) for n, row in zip(counts, chance))
    assert likelihood == pytest.approx(expected)


def test_quality_posteriors_of_given_evidence(spark):
    """Means of hosts and paths, and scores, computed anew from the evidence column."""
    got = queries.op2_quality(spark, SF_DIR).toPandas().fillna({"host": "-", "path": "-"})
    prior = got.evidence.mean()

    def strength(groups, mean):
        inside = mean * (1 - mean)
        between = max((groups.n * (groups.good / groups.n - mean) ** 2).sum() - np.sum(inside * np.ones(len(groups))), 0)
        between /= groups.n.sum()
        scale = (groups.n * inside).sum() / groups.n.sum()
        return min(max(scale / between - 1, 1), 1e4) if between > 0 else 1e4

    hosts = got.groupby("host").evidence.agg(good="sum", n="count")
    k = strength(hosts, prior)
    hosts["host_mean"] = (hosts.good + k * prior) / (hosts.n + k)
    paths = got.groupby(["host", "path"]).evidence.agg(good="sum", n="count").join(hosts.host_mean)
    k = strength(paths, paths.host_mean)
    paths["path_mean"] = (paths.good + k * paths.host_mean) / (paths.n + k)
    both = got.merge(paths.reset_index(), on=["host", "path"], suffixes=("", "_own"))
    assert len(both) == len(got) == 1000
    assert both.host_mean.to_numpy() == pytest.approx(both.host_mean_own.to_numpy())
    assert both.path_mean.to_numpy() == pytest.approx(both.path_mean_own.to_numpy())
    others = (both.good - both.evidence + k * both.host_mean_own) / (both.n - 1 + k)
    odds = both.evidence / (1 - both.evidence) * others / (1 - others) / (prior / (1 - prior))
    assert both.score.to_numpy() == pytest.approx((odds / (1 + odds)).to_numpy())


def test_quality_of_held_out_documents(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    fifth = F.crc32(F.col("doc_id").cast("string")) % 5
    found = quality.site_quality(docs, labels.where(fifth != 0), F.col("source"), F.col("lang"))
    held = found.join(labels.where(fifth == 0), "doc_id").toPandas()
    assert len(held) > 20 and (held.keep == (held.quality == 1)).mean() > 0.95
