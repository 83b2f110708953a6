"""Quality by hierarchical empirical Bayes.

A logistic classifier over simple counts gives each document a chance of being good. Grouped sums of
these chances give each host, and each path within a host, a posterior mean: a host is shrunk
towards the mean of all documents, a path towards its host, the more the fewer documents it has.
How much is read off the data, from the spread of host and path means beyond what chance alone
would give. A document's score joins its own evidence and its path's posterior without itself.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.shared import written

MAX_LABELLED = 10_000
FEATURES = (
    "symbols", "digits", "upper", "marks", "bars", "breaks", "log_length", "distinct", "word_length"
)

_SYMBOLS, _DIGITS, _MARKS = "#$%&*+<=>@\\^_`~{}[]", "0123456789", ".,;:!?"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def features(text: Column) -> dict[str, Column]:
    """Numbers between 0 and about 1, or 0 for NULL and empty texts."""
    text = F.coalesce(text, F.lit(""))
    chars = F.greatest(F.length(text), F.lit(1))
    words = F.split(text, r"[ \t-\r]+")

    def share(of: str) -> Column:
        return (F.length(text) - F.length(F.translate(text, of, ""))) / chars

    return {
        "symbols": share(_SYMBOLS),
        "digits": share(_DIGITS),
        "upper": share(_UPPER),
        "marks": share(_MARKS),
        "bars": share("|"),
        "breaks": share("\n"),
        "log_length": F.log1p(F.length(text)) / 10,
        "distinct": F.size(F.array_distinct(words)) / F.size(words),
        "word_length": F.length(text) / F.size(words) / 10,
    }


def fit(measured: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> np.ndarray | None:
    """Weights of the classifier (the last is the constant) from at most `most` labelled ids of
    each class, chosen by a hash of the id, and of the rows of one id the one with the smallest
    measures; None if only one class, or none, is labelled."""
    known = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [known.where(F.col("quality") == c).orderBy(*order).limit(most) for c in (0, 1)]
    found = measured.join(F.broadcast(chosen[0].union(chosen[1])), "doc_id")
    # one row of each id, however often it occurs
    one = F.min(F.struct(*FEATURES, "quality")).alias("one")
    rows = found.groupBy("doc_id").agg(one).select("one.*")
    # in one order on every run, so that sums agree
    data = np.array(sorted(rows.select(*FEATURES, "quality").collect()), dtype=float)
    if not len(data) or data[:, -1].min() == data[:, -1].max():
        return None
    x, y = np.column_stack([data[:, :-1], np.ones(len(data))]), data[:, -1]
    importance = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    weights = np.zeros(x.shape[1])
    for _ in range(30):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (importance * (y - p)) - 0.1 * weights
        curve = (x * (importance * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(weights))
        weights = weights + np.linalg.solve(curve, gradient)
    return weights


def _strength(groups: DataFrame, parent: str | float) -> float:
    """Documents that the parent's mean weighs as much as, by the method of moments."""
    mean = F.col(parent) if isinstance(parent, str) else F.lit(parent)
    inside = mean * (1 - mean)
    got = groups.agg(
        F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - mean, 2)).alias("spread"),
        F.sum(inside).alias("chance"),
        F.sum(F.col("n") * inside).alias("scale"),
        F.sum("n").alias("n"),
    ).first()
    if not got.n:
        return 1.0
    between = max(got.spread - got.chance, 0.0) / got.n
    return float(np.clip(got.scale / got.n / between - 1, 1.0, 1e4)) if between > 0 else 1e4


def site_quality(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """(doc_id, host, path, evidence, host_mean, path_mean, score, keep), one row per row of
    `docs(doc_id, text, ...)`.

    `host` and `path` are expressions over `docs`; NULL is a host or path of its own.
    `labels(doc_id, quality)` teach the classifier; without labels of both classes all evidence is
    one half. NULL and empty texts have their counts at zero. An empty table gives no rows.
    """
    measured = written(
        docs.select(
            "doc_id", host.cast("string").alias("host"), path.cast("string").alias("path"),
            *[c.alias(n) for n, c in features(F.col("text")).items()],
        ),
        "measured",
    )
    weights = fit(measured, labels)
    logit = F.lit(0.0) if weights is None else sum(
        (F.col(n) * float(w) for n, w in zip(FEATURES, weights)), F.lit(float(weights[-1]))
    )
    logit = F.greatest(F.lit(-12.0), F.least(F.lit(12.0), logit))
    judged = measured.select("doc_id", "host", "path", (1 / (1 + F.exp(-logit))).alias("evidence"))
    paths = written(
        judged.groupBy("host", "path").agg(F.sum("evidence").alias("good"), F.count("*").alias("n")),
        "paths",
    )
    hosts = paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    all_docs = hosts.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    prior = all_docs.good / all_docs.n if all_docs.n else 0.5
    k_host = _strength(hosts, prior)
    hosts = hosts.select(
        F.col("host").alias("h"),
        ((F.col("good") + k_host * prior) / (F.col("n") + k_host)).alias("host_mean"),
    )
    paths = written(paths.join(hosts, F.col("host").eqNullSafe(F.col("h"))).drop("h"), "posteriors")
    k_path = _strength(paths, "host_mean")
    table = paths.select(
        F.col("host").alias("h"), F.col("path").alias("p"), "good", "n", "host_mean",
        ((F.col("good") + k_path * F.col("host_mean")) / (F.col("n") + k_path)).alias("path_mean"),
    )
    same = F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p"))
    others = (F.col("good") - F.col("evidence") + k_path * F.col("host_mean")) / (
        F.col("n") - 1 + k_path
    )
    odds = F.log(F.col("evidence") / (1 - F.col("evidence"))) + F.log(others / (1 - others))
    score = 1 / (1 + F.exp(-(odds - float(np.log(prior / (1 - prior))))))
    return judged.join(table, same).select(
        "doc_id", "host", "path", "evidence", "host_mean", "path_mean",
        score.alias("score"), (score >= 0.5).alias("keep"),
    )
