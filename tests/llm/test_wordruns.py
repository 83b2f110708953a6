import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from martloom.llm import queries
from martloom.llm.wordruns import candidates, collapsed, periodic_runs, runs_within, word_runs

SF_DIR = "/root/testdata/sf0.01"


def plain_runs(words, times=4, least=6):
    """The definition, period by period."""
    numbers = {}
    w = np.array([numbers.setdefault(x, len(numbers)) for x in words])
    out = []
    for q in range(1, len(words) // times + 1):
        same = np.concatenate([[0], w[q:] == w[:-q], [0]]).astype(np.int8)
        edges = np.flatnonzero(np.diff(same)).tolist()
        for start, stop in zip(edges[::2], edges[1::2]):
            length, part = stop - start + q, w[start : stop + q]
            if length < max(least, times * q):
                continue
            if not any((part[r:] == part[:-r]).all() for r in range(1, q)):
                out.append((start, length, q))
    return sorted(out)


def made_words(choose):
    letters = [b"a", b"b", b"c", b"d", b"e", b"f"][: choose.choice([1, 2, 3, 6])]
    words, size = [], choose.randrange(90)
    while len(words) < size:
        if choose.random() < 0.5:
            words.append(choose.choice(letters))
        else:
            part = choose.choices(letters, k=choose.randrange(1, 9))
            words += (part * 8)[: choose.randrange(1, 7 * len(part))]
    return words


@pytest.mark.parametrize("times, least", [(4, 6), (3, 1), (5, 20)])
def test_runs_are_their_definition(times, least):
    choose = random.Random(times)
    for _ in range(1_000):
        words = made_words(choose)
        expected = plain_runs(words, times, least)
        assert word_runs(words, times, least) == expected
        assert runs_within(words, times, least) == expected  # without the search for candidates


@pytest.mark.parametrize("size, period", [(20_000, 1), (20_000, 3), (20_000, 5_000), (19_999, 5_000)])
def test_long_texts(size, period):
    words = [b"w%d" % (n % period) for n in range(size)]
    assert word_runs(words) == ([(0, size, period)] if size >= 4 * period else [])
    around = [b"x", *words, b"y"]
    assert word_runs(around) == ([(1, size, period)] if size >= 4 * period else [])


def test_plain_text_has_no_candidates():
    choose = random.Random(1)
    words = np.array([choose.randrange(300) for _ in range(20_000)], dtype=np.uint64)
    assert sum(b - a for a, b in candidates(words)) < 2_000


def test_collapsed_keeps_one_period():
    words = b"say it a b a b a b a b a now now now now now now end".split()
    runs = word_runs(words)
    assert runs == [(2, 9, 2), (11, 6, 1)]
    assert b" ".join(collapsed(words, runs)) == b"say it a b now end"


def test_odd_rows(docs):
    table = docs(
        (1, None), (1, None), (None, ""), (2, " \t\n"), (3, "x " * 50_000, "en"), (4, "a\x0bb"), (5, "Ää Ö " * 6),
    )
    table = table.withColumns({c: table.text for c in ("runs", "collapsed", "n_words")})
    got = periodic_runs(table)
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    rows = sorted(
        ((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()), key=repr
    )
    assert rows == sorted(
        [(1, 0, [], ""), (1, 0, [], ""), (None, 0, [], ""), (2, 0, [], ""), (3, 50_000, [(0, 50_000, 1)], "x"),
         (4, 2, [], "a b"), (5, 6, [(0, 6, 1)], "Ää Ö")],
        key=repr,
    )
    assert periodic_runs(docs()).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(docs(), times=2)


def expected_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    milli = 1000 * best[1] // best[2] if runs else None
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)]
    return (doc_id, len(runs), *best, milli, *digests, n)


def test_query_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = {tuple(r) for r in queries.op13_runs(spark, SF_DIR).collect()}
    assert len(got) == len(table)
    assert got == {expected_row(*r) for r in table}


def test_query_on_odd_rows(spark, docs, tmp_path):
    texts = [None, "", " ", "one", "a b c", "w " * 5, "w " * 6, "a b " * 4, "A  b " * 9, " lead a b c d e f g h\n\n" * 3]
    data = [(i, texts[i % len(texts)]) for i in range(400)] + [(None, "a a a a a a"), (None, None)]
    docs(*data).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, queries.op13_runs(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted((expected_row(*d) for d in data), key=repr)
