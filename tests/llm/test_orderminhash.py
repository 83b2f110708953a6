import hashlib

import numpy as np
import pytest

from martloom.llm import orderminhash as omh
from martloom.llm import queries

SF_DIR = "/root/testdata/sf0.01"


def sketch(text):
    return omh.sketch(omh.kmer_hashes(omh.code_points(text)))


def plain_sketch(text):
    """The definition with lists and dictionaries, from the same k-mer hashes."""
    hashes = omh.kmer_hashes(omh.code_points(text)).tolist()
    seen, bins = {}, {}
    for place, h in enumerate(hashes):
        nth = seen[h] = seen.get(h, -1) + 1
        value = int(omh.mixed(np.array([h], np.uint64) + np.uint64(nth) * omh.MULTIPLIER)[0])
        bins.setdefault(value >> 58, []).append((value, place))
    out = [0] * omh.BINS
    for number, members in bins.items():
        least = sorted(sorted(members)[: omh.KEPT], key=lambda m: m[1])
        tuple_ = np.zeros(1, np.uint64)
        for value, _ in least:
            tuple_ = omh.mixed(tuple_ * omh.MULTIPLIER + np.uint64(value))
        out[number] = max(1, int(tuple_[0]) >> 32)
    return out


@pytest.mark.parametrize(
    "text", [None, "", "a", "short", "a longer text, longer text, longer text", "äöü" * 500, "x" * 5000]
)
def test_sketch_is_its_definition(text):
    assert sketch(text).tolist() == plain_sketch(text)


def test_likeness_follows_edits_and_order():
    random = np.random.default_rng(1)
    words = ["".join(map(chr, random.integers(97, 123, 6))) for _ in range(1200)]
    text = " ".join(words)
    few = " ".join(words[:1140] + words[:60])
    half = " ".join(words[:600] + ["".join(map(chr, random.integers(97, 123, 6))) for _ in range(600)])
    shuffled = " ".join(random.permutation(words))
    close, middle, moved = (omh.likeness(sketch(text), sketch(t)) for t in (few, half, shuffled))
    assert omh.likeness(sketch(text), sketch(text)) == 1
    assert close > 0.85 > middle > 0.3 and moved < 0.2
    blocks = " ".join(words[600:] + words[:600])  # same words, other order
    assert omh.likeness(sketch(text), sketch(blocks)) < 0.9


def edited_by_hand(rows):
    """doc_id -> (edited text, next text), rows sorted by id."""
    rows = sorted(set(rows))
    out = {}
    for at, (doc_id, text) in enumerate(rows):
        after = rows[(at + 1) % len(rows)][1]
        quarter = len(text) // 4
        out[doc_id] = text[: len(text) - quarter] + after[:quarter], after
    return out


def test_query_equals_brute_force(spark):
    table = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    expected = edited_by_hand(table)
    texts = dict(table)
    got = queries.op5_fingerprints(spark, SF_DIR).collect()
    assert len(got) == len(table)
    for r in got:
        edited, after = expected[r.doc_id]
        own = sketch(texts[r.doc_id])
        assert r.n_chars == len(texts[r.doc_id])
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == own.tobytes().hex()
        assert r.edited_fingerprint == sketch(edited).tobytes().hex()
        assert r.near_edited == omh.likeness(own, sketch(edited))
        assert r.near_next == omh.likeness(own, sketch(after))
    assert np.mean([r.near_edited > r.near_next for r in got]) > 0.99


def test_odd_rows(docs):
    long = "word " * 60_000
    table = docs((3, None), (1, "abcdefgh"), (2, ""), (2, ""), (None, "null id"), (9, long), (9, "other"))
    rows = omh.edited_fingerprints(table).collect()
    assert len(rows) == 7
    digests = {r.edited_sha256 for r in rows if r.doc_id == 2}
    assert digests == {hashlib.sha256(b"").hexdigest()}
    first = next(r for r in rows if r.doc_id == 1)
    assert first.edited_sha256 == hashlib.sha256(b"abcdef").hexdigest()
    assert next(r for r in rows if r.doc_id is None).n_chars == 7
    assert omh.edited_fingerprints(docs()).count() == 0
    alone = omh.edited_fingerprints(docs((1, "abcdefgh"))).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and alone.near_next == 1
