"""Language of a text by multilingual mixture inference.

Each known language has a distribution over hashed byte n-grams of lower-cased letters. A text is
taken as drawn from a mixture of languages whose shares are found by expectation-maximisation. Of
the nested sets of its likeliest languages the one with the best likelihood, penalised for each
language beyond the first, is kept; the language with the largest share is the answer.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.grams import LETTERS_ONLY, gram_buckets

SIZES = (1, 2, 3)
BITS = 14
ROUNDS = 12
PENALTY = 2.0
NONE = "und"

_LETTER = re.compile(r"[^\W\d_]")
_PIECE = 1 << 20


def gram_counts(text: str | None) -> np.ndarray:
    """Counts of all n-grams of the letters of a text, words separated by one space."""
    words = (text or "").lower().encode().translate(LETTERS_ONLY).split()
    data = np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8)
    counts = np.zeros(1 << BITS, dtype=np.int64)
    for at in range(0, len(data), _PIECE):  # pieces keep the memory for a long text small
        for n in SIZES:
            counts += np.bincount(
                gram_buckets(data[at : at + _PIECE + n - 1], n, BITS), minlength=1 << BITS
            )
    return counts


def has_letters(text: str | None) -> bool:
    return bool(text) and any(m[0].isalpha() for m in _LETTER.finditer(text))


def learn(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and the logarithm-free n-gram distributions (n-gram x language) of
    `labelled(text, lang)`. Rows without text or language are left out. Counts are summed in each
    task and then by Spark; the driver gets one row per language and n-gram bucket."""

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"]):
                if lang not in sums:
                    sums[lang] = np.zeros(1 << BITS, dtype=np.int64)
                sums[lang] += gram_counts(text)
        for lang, counts in sums.items():
            bucket = np.flatnonzero(counts)
            yield pd.DataFrame({"lang": lang, "bucket": bucket, "n": counts[bucket]})

    counted = (
        labelled.where("text IS NOT NULL AND lang IS NOT NULL")
        .select("text", "lang")
        .mapInPandas(count, "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    ).toArrow()
    langs = sorted(set(counted["lang"].to_pylist()))
    table = np.full((1 << BITS, len(langs)), 0.5)
    if langs:
        column = np.searchsorted(np.array(langs), np.array(counted["lang"].to_pylist()))
        table[counted["bucket"].to_numpy(), column] += counted["n"].to_numpy()
    return langs, (table / table.sum(axis=0, keepdims=True)).astype(np.float64)


def shares(counts: np.ndarray, chance: np.ndarray, rounds: int = ROUNDS):
    """Mixture shares by expectation-maximisation, and the log-likelihood they give."""
    pi = np.full(chance.shape[1], 1 / chance.shape[1])
    for _ in range(rounds):
        weight = counts / (chance @ pi)
        pi = pi * (weight @ chance)
        pi /= pi.sum()
    return pi, float(counts @ np.log(chance @ pi))


def infer(counts: np.ndarray, table: np.ndarray, penalty: float = PENALTY):
    """(columns of the chosen languages, their shares), largest share first."""
    seen = np.flatnonzero(counts)
    counts = counts[seen].astype(np.float64)
    chance = table[seen]
    alone = counts @ np.log(chance)
    best = [int(np.argmax(alone))], np.ones(1)
    score = alone.max()
    if table.shape[1] == 1:
        return best
    pi, _ = shares(counts, chance)
    order = np.argsort(-pi, kind="stable")
    cost = penalty * np.log(counts.sum())
    for size in range(2, int((pi > 0.01).sum()) + 1):
        chosen = order[:size]
        part, likelihood = shares(counts, chance[:, chosen])
        if likelihood - cost * (size - 1) <= score:
            break
        score = likelihood - cost * (size - 1)
        ranked = np.argsort(-part, kind="stable")
        best = [int(c) for c in chosen[ranked]], part[ranked]
    return best


def languages(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """(doc_id, lang_pred, score, langs, shares), one row per row of `docs(doc_id, text)`.

    `labelled(text, lang)` teaches the languages. lang_pred is `und`, with score 0 and no shares,
    for texts that are NULL or hold no letter, and where no language is known; score is the share
    of lang_pred. Ties go to the language whose name is first. The whole text counts.
    """
    langs, table = learn(labelled)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def predict(batches):
        table = shared.value
        for batch in batches:
            out = []
            for text in batch["text"]:
                if langs and has_letters(text):
                    columns, parts = infer(gram_counts(text), table)
                    names = [langs[c] for c in columns]
                    out.append((names[0], min(1.0, float(parts[0])), names, parts.tolist()))
                else:
                    out.append((NONE, 0.0, [], []))
            made = pd.DataFrame(out, columns=["lang_pred", "score", "langs", "shares"])
            made.insert(0, "doc_id", batch["doc_id"])
            yield made

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(
        predict,
        f"doc_id {kind}, lang_pred string, score double, langs array<string>, shares array<double>",
    )
