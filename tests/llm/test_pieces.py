import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from martloom.llm import queries
from martloom.llm.pieces import FEW, PieceModel, decoded, encoded

SF_DIR = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return PieceModel.load(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def spans(pieces):
    return [(p.id, p.begin, p.end) for p in pieces]


def own_spans(model, text):
    return list(zip(*(column.tolist() for column in model.encode([text])[0])))


def texts(seed, n, letters):
    choose = random.Random(seed)
    return ["".join(choose.choices(letters, k=choose.randrange(60))) for _ in range(n)]


LETTERS = "ab the in er  ▁\n\t<0x41></s>é中文\U0001f600\x00́�12.,"
MANY = "".join(map(chr, range(32, 0x500)))


@pytest.mark.parametrize("letters", [LETTERS, MANY, "aon ", " ", "an"])
def test_pieces_and_spans_are_those_of_the_library(model, library, letters):
    for text in texts(1, 500, letters):
        assert own_spans(model, text) == spans(library.encode(text, return_type="proto").pieces)


def test_long_stretches_are_merged_as_short_ones(model, library):
    choose = random.Random(2)
    for size in (FEW - 1, FEW, FEW + 1, 5_000):
        text = "".join(choose.choices("aeinorst", k=size))
        assert model.encode([text])[0][0].tolist() == library.encode(text)
    text = " " * 1_000 + "x" + " " * 999
    assert model.encode([text])[0][0].tolist() == library.encode(text)


@pytest.mark.parametrize("prefix, trimmed", [(True, True), (True, False), (False, True)])
def test_longest_rules_of_a_compiled_map(prefix, trimmed):
    """The map of the public NFKC rules put into the model."""
    rules = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto()
    with open(PATH, "rb") as file:
        changed = proto.ModelProto.FromString(file.read())
    spec = changed.normalizer_spec
    spec.precompiled_charsmap = proto.ModelProto.FromString(rules).normalizer_spec.precompiled_charsmap
    spec.add_dummy_prefix, spec.remove_extra_whitespaces = prefix, trimmed
    content = changed.SerializeToString()
    library = sentencepiece.SentencePieceProcessor(model_proto=content)
    model = PieceModel.from_bytes(content)
    compatible = "".join(map(chr, range(0x2000, 0x2200))) + "  "
    for letters in ("a  b ﬁ①ﷺ ㌔　\t\n​­́é éｱﾞ中", compatible):
        for text in texts(3, 500, letters):
            assert own_spans(model, text) == spans(library.encode(text, return_type="proto").pieces)
            ids = library.encode(text)
            assert model.decode(ids) == library.decode(ids)


def test_decoding_any_ids(model, library):
    choose = random.Random(4)
    for _ in range(3_000):
        ids = [choose.choice([choose.randrange(300), choose.randrange(32_000)]) for _ in range(choose.randrange(8))]
        assert model.decode(ids) == library.decode(ids), ids


def test_odd_rows(spark, docs, model, library):
    table = docs((1, None), (1, None), (None, ""), (2, "x " * 200_000, "en"), (3, "a b", None, "s"))
    table = table.withColumn("ids", table.text).withColumn("begins", table.text)
    got = encoded(table, model)
    assert got.columns == ["doc_id", "ids", "begins", "ends"]
    rows = {(r.doc_id, len(r.ids)): r for r in got.collect()}
    assert sorted(map(str, rows)) == sorted(map(str, [(1, 1), (None, 1), (2, 200_002), (3, 3)]))
    assert rows[3, 3].ids == [*library.encode("a b"), 2]
    assert (rows[3, 3].begins, rows[3, 3].ends) == ([0, 1, 3], [1, 3, 3])
    back = decoded(got, model).where("doc_id = 2").first().text
    assert back == "x " * 200_000
    assert encoded(docs(), model).count() == decoded(encoded(docs(), model), model).count() == 0


def test_query_on_the_whole_table_equals_the_library(spark, library):
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet").toPandas()
    got = queries.op11_pieces(spark, SF_DIR).toPandas().set_index("doc_id")
    assert len(got) == len(given)

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    spans = spark.createDataFrame(
        [
            (doc_id, [p.begin for p in found] + [size], [p.end for p in found] + [size])
            for doc_id, text in zip(given.doc_id, given.text)
            for found, size in [(library.encode(text, return_type="proto").pieces, len(text.encode()))]
        ],
        "doc_id long, begins array<int>, ends array<int>",
    ).select("doc_id", F.xxhash64("begins", "ends"))
    spans = dict(map(tuple, spans.collect()))
    for doc_id, text in zip(given.doc_id, given.text):
        ids = [*library.encode(text), 2]
        assert tuple(got.loc[doc_id]) == (
            len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids)), spans[doc_id],
        )
