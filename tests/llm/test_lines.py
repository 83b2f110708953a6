from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from martloom.llm import lines


def plain(texts, least, chars):
    def key(line):
        return "".join(
            c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r")
        )

    split = [(t or "").split("\n") for t in texts]
    found = Counter(k for ls in split for k in {key(x) for x in ls} if len(k) >= chars)
    return [
        (len(ls), sum(found[key(x)] >= least for x in ls),
         "\n".join(x for x in ls if found[key(x)] < least))
        for ls in split
    ]


def got(table, *args):
    found = lines.without_common_lines(table, *args).collect()
    return sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in found)


LINE = st.sampled_from(["", " ", "a", "A ", "\ta\r", "b", "É", "é", " a", "long line", "x"])


@settings(deadline=None, max_examples=25)
@given(texts=st.lists(st.one_of(st.none(), st.lists(LINE, max_size=6).map("\n".join)), min_size=1, max_size=8))
def test_equals_counting_by_hand(spark, texts):
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = [(i, *p) for i, p in enumerate(plain(texts, 2, 1))]
    assert got(table, 2, 1) == expected


def test_odd_rows(docs):
    long = "\n".join(f"line {i}" for i in range(30_000)) + "\nshared"
    table = docs((1, long), (2, "Shared\nown"), (None, "shared "), (None, "shared "), (3, None), (4, "own\n\n"))
    found = lines.without_common_lines(table.withColumnRenamed("extra", "n_lines"), 3)
    by = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text[-10:]) for r in found.collect()), key=repr)
    assert by == sorted(
        [(1, 30_001, 1, "line 29999"), (2, 2, 1, "own"), (None, 1, 1, ""), (None, 1, 1, ""),
         (3, 1, 0, ""), (4, 3, 0, "own\n\n")], key=repr
    )
    assert found.columns.count("n_lines") == 1
    assert lines.without_common_lines(docs()).count() == 0


def test_positions_not_texts_are_exploded(docs):
    plan = lines.without_common_lines(docs((1, "a"))).select("doc_id", "kept_text")
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()


def test_columns_of_any_name_stay(docs):
    """With a third of all rows alike."""
    data = [(i % 3 or i, "the same\nline" if i % 3 else f"line {i}\nthe same") for i in range(60)]
    table = docs(*data)
    names = ("k1", "K2", "dropped", "places", "split", "_k1", "hashes", "a.b")
    table = table.withColumns({c: F.lit(c) for c in names})
    got = lines.without_common_lines(table)
    assert got.columns == [*table.columns, "n_lines", "n_dropped", "kept_text"]
    rows = got.collect()
    assert len(rows) == 60 and all(r[c] == c for r in rows for c in names)
    assert {r.kept_text for r in rows} == {"", *[f"line {i}" for i in range(0, 60, 3)]}
