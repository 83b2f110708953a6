"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is a logistic function of its hashed words and
byte n-grams, a document's is the noisy-or of its sentences, and the weights are fitted so that the
document scores agree with document labels. The sentence scores then say where the offence is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.grams import gram_buckets, word_buckets
from martloom.shared import written

SIZES = (4, 5, 6)
BITS = 18
MAX_LABELLED = 5_000
FEATURES = 2_000
ROUNDS = 200
RIDGE = 1e-4

_PIECE = 1 << 20
_WORD = b"0123456789abcdefghijklmnopqrstuvwxyz"
#: Ends of sentences become line breaks, what is neither letter nor digit becomes a space.
_TO_SENTENCES = bytes(
    c if c > 127 or c in _WORD else 10 if c in b".!?\n\r" else 32 for c in range(256)
)
_END = 10


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # one for each n-gram bucket
    bias: float


def pieces(text: str | None) -> Iterator[tuple[int, np.ndarray]]:
    """The lower-cased text as bytes, in pieces of whole sentences with their offsets.

    A piece has about `_PIECE` bytes, more only where one sentence has, so that a long text needs
    no arrays of its own length.
    """
    data = (text or "").lower().encode().translate(_TO_SENTENCES) + b"\n"
    at = 0
    while at < len(data):
        end = data.rfind(b"\n", at, at + _PIECE) + 1
        if not end:
            end = data.index(b"\n", at) + 1
        yield at, np.frombuffer(data[at:end], dtype=np.uint8)
        at = end


def sentence_starts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each stretch between line breaks, and whether it holds a letter or digit."""
    starts = np.concatenate([[0], np.flatnonzero(data[:-1] == _END) + 1])
    return starts, np.maximum.reduceat(data > 32, starts)


def features(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and buckets of the n-grams of each size, then of the words."""
    for n in SIZES:
        buckets = gram_buckets(data, n, BITS)
        yield np.arange(len(buckets)), buckets
    yield word_buckets(data, BITS)


def sentence_scores(text: str | None, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Starts (in bytes) and scores of the sentences that hold a letter or digit."""
    all_starts, all_scores = [], []
    for offset, data in pieces(text):
        starts, filled = sentence_starts(data)
        value = np.zeros(len(data), dtype=np.float64)
        for places, buckets in features(data):
            value[places] += model.weights[buckets]
        sums = np.add.reduceat(value, starts)[filled] + model.bias
        all_starts.append(offset + starts[filled])
        all_scores.append(1 / (1 + np.exp(-np.clip(sums, -60, 60))))
    return np.concatenate(all_starts), np.concatenate(all_scores)


def noisy_or(scores: np.ndarray) -> float:
    return float(-np.expm1(np.log1p(-np.minimum(scores, 1 - 1e-12)).sum()))


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """(text, toxic) of at most `most` labelled ids of each class, chosen by a hash of the id.

    An id labelled more than once is toxic if any label says so; NULL ids and labels don't count.
    The chosen ids are at most 2 * `most`, so they go to the documents by broadcast. Of the rows of
    one id the text with the least hash is taken, so the sample has no more rows than ids.
    """
    known = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [known.where(F.col("toxic") == c).orderBy(*order).limit(most) for c in (0, 1)]
    both = chosen[0].union(chosen[1])
    found = docs.select("doc_id", "text").join(F.broadcast(both), "doc_id")
    one = F.min_by(F.struct("text", "toxic"), F.struct(F.xxhash64("text"), "text")).alias("one")
    return found.groupBy("doc_id").agg(one).select("one.text", "one.toxic")


def _telling_buckets(sample: DataFrame, most: int) -> np.ndarray:
    """The buckets that speak most for the label (chi square), of those that do speak for it."""

    def count(batches):
        sums = np.zeros((2, 1 << BITS), dtype=np.int64)
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                seen = np.zeros(1 << BITS, dtype=bool)
                for _, data in pieces(text):
                    for _, buckets in features(data):
                        seen[buckets] = True
                sums[int(toxic > 0)] += seen
        bucket = np.flatnonzero(sums.any(axis=0))
        yield pd.DataFrame({"bucket": bucket, "n0": sums[0, bucket], "n1": sums[1, bucket]})

    got = (
        sample.mapInPandas(count, "bucket int, n0 long, n1 long")
        .groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .where("n0 + n1 >= 3")
        .toArrow()
    )
    bucket = got["bucket"].to_numpy()
    n0, n1 = got["n0"].to_numpy().astype(float), got["n1"].to_numpy().astype(float)
    by_class = dict(sample.groupBy("toxic").count().collect())
    t0, t1 = float(by_class.get(0, 0)), float(by_class.get(1, 0))
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = (n1 * (t0 - n0) - n0 * (t1 - n1)) ** 2 / ((n0 + n1) * (t0 + t1 - n0 - n1))
        chi = np.where(n1 * t0 > n0 * t1, chi, 0.0)
    chi = np.nan_to_num(chi, nan=0.0, posinf=0.0)
    order = np.lexsort((bucket, -chi))[:most]
    return np.sort(bucket[order[chi[order] > 0]])


def _bags(sample: DataFrame, buckets: np.ndarray) -> list:
    """(toxic, sentences, sentence of each telling n-gram, its index) of each labelled document."""
    shared = sample.sparkSession.sparkContext.broadcast(buckets)

    def sparse(batches):
        index = np.full(1 << BITS, -1, dtype=np.int32)
        index[shared.value] = np.arange(len(shared.value), dtype=np.int32)
        for batch in batches:
            out = []
            for text, toxic in zip(batch["text"], batch["toxic"]):
                at, which, n = [np.zeros(0, int)], [np.zeros(0, int)], 0
                for _, data in pieces(text):
                    starts, filled = sentence_starts(data)
                    number = n + np.cumsum(filled) - 1
                    for places, buckets in features(data):
                        found = index[buckets]
                        known = found >= 0
                        owner = np.searchsorted(starts, places[known], side="right") - 1
                        inside = filled[owner]
                        at.append(number[owner[inside]])
                        which.append(found[known][inside])
                    n += int(filled.sum())
                out.append(
                    (int(toxic > 0), n,
                     np.concatenate(at).astype(np.int32).tobytes(),
                     np.concatenate(which).astype(np.int32).tobytes())
                )
            yield pd.DataFrame(out, columns=["toxic", "n", "at", "which"])

    return sample.mapInPandas(sparse, "toxic int, n int, at binary, which binary").collect()


def weigh(bags: list[tuple], features: int, rounds: int = ROUNDS) -> np.ndarray:
    """Weights and, last, the bias that maximise the likelihood of bags (toxic, sentences, sentence
    of each feature, feature), by gradient ascent (Adam). Weights don't fall below zero: nothing in
    a sentence makes up for an offence. Either class has half the weight."""
    y = np.array([b[0] for b in bags], dtype=float)
    sizes = np.array([b[1] for b in bags])
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    sentence = np.concatenate([b[2] + f for b, f in zip(bags, first)])
    feature = np.concatenate([b[3] for b in bags])
    bag = np.repeat(np.arange(len(bags)), sizes)
    importance = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    theta = np.zeros(features + 1)
    theta[-1] = -4.0
    slope, square = np.zeros_like(theta), np.zeros_like(theta)
    for turn in range(1, rounds + 1):
        z = np.bincount(sentence, weights=theta[feature], minlength=sizes.sum()) + theta[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        none = np.exp(np.add.reduceat(np.log1p(-np.minimum(p, 1 - 1e-9)), first))
        pull = np.where(y > 0, none / np.maximum(1 - none, 1e-9), -1.0) * importance
        by_sentence = p * pull[bag]
        gradient = np.append(
            np.bincount(feature, weights=by_sentence[sentence], minlength=features),
            by_sentence.sum(),
        )
        gradient[:-1] -= RIDGE * theta[:-1]
        slope = 0.9 * slope + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        step = slope / (1 - 0.9**turn) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-8)
        theta = theta + 0.1 * step
        theta[:-1] = np.maximum(theta[:-1], 0.0)
    return theta


def fit(sample: DataFrame, features: int = FEATURES, rounds: int = ROUNDS) -> Model | None:
    """The model of `sample(text, toxic)`, which must be bounded; None if only one class, or none,
    is labelled. Ties in the choice of `features` go to the smaller bucket, so that reruns on one
    sample agree."""
    sample = written(sample, "labelled")
    buckets = _telling_buckets(sample, features)
    rows = sorted((r for r in _bags(sample, buckets) if r.n), key=tuple)
    bags = [
        (r.toxic, r.n, np.frombuffer(r.at, np.int32), np.frombuffer(r.which, np.int32))
        for r in rows
    ]
    if len({b[0] for b in bags}) < 2:
        return None
    theta = weigh(bags, len(buckets), rounds)
    weights = np.zeros(1 << BITS, dtype=np.float32)
    weights[buckets] = theta[:-1]
    return Model(weights, float(theta[-1]))


def with_toxicity(docs: DataFrame, model: Model | None) -> DataFrame:
    """`docs(text, ...)` with a column `toxicity` (which replaces one of that name): a struct of
    score, predicted, sentences (their number), worst (the sentence with the highest score, the
    first of equal ones) and worst_score.

    Texts that are NULL or hold no letter or digit have score 0 and no worst sentence, as has
    every text if there is no model. The whole text counts. An empty table gives no rows.
    """
    # plain arrays: a broadcast is read where this package may be missing
    parts = (model.weights, model.bias) if model else None
    shared = docs.sparkSession.sparkContext.broadcast(parts)

    @F.pandas_udf(
        "score double, predicted int, sentences int, worst string, worst_score double"
    )
    def judge(texts: pd.Series) -> pd.DataFrame:
        model = Model(*shared.value) if shared.value else None
        out = []
        for text in texts:
            starts, scores = sentence_scores(text, model) if model else ((), ())
            if not len(scores):
                out.append((0.0, 0, 0, None, 0.0))
                continue
            top = int(np.argmax(scores))
            data = text.lower().encode()
            stop = int(starts[top + 1]) if top + 1 < len(starts) else len(data)
            worst = data[starts[top] : stop].decode(errors="replace").strip()
            total = noisy_or(scores)
            out.append((total, int(total >= 0.5), len(scores), worst, float(scores[top])))
        return pd.DataFrame(
            out, columns=["score", "predicted", "sentences", "worst", "worst_score"]
        )

    return docs.drop("toxicity").withColumn("toxicity", judge("text"))
