import random

import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from ebbline.llm.pieces import SPACE, Chunk, Vocabulary, combine, decode, encode, round_trip, states_at_cuts
from ebbline.llm.queries import piece_model

MODEL = piece_model()


def unigram_model() -> bytes:
    """The same pieces with graded scores as a unigram model, without spaces of its own making."""
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(MODEL)
    proto.trainer_spec.model_type = 1
    for i, piece in enumerate(proto.pieces):
        if piece.type == 1:
            piece.score = -8.0 - (i % 997) / 997 - 0.01 * (i / 1000)
    return proto.SerializeToString()


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(MODEL)


def scanned(vocabulary, text, size):
    spaced = vocabulary.prefix + text.replace(" ", SPACE)
    chunks = []
    for begin in range(0, len(spaced), size):
        at, end = max(0, begin - vocabulary.longest - 1), min(begin + size, len(spaced))
        chunks.append(Chunk(vocabulary, spaced[at:end + vocabulary.longest + 1], at, begin, end, len(spaced)))
    matrices = [c.matrix() for c in chunks]
    states = states_at_cuts(matrices)
    return [i for c, (a, b) in zip(chunks, states) for i in c.trace(a, b)], matrices


def samples(vocabulary, count, seed=4):
    draw = random.Random(seed)
    kinds = ["abcdefgh  ", " ", "a", "the ", "éßñ漢字😀 a", "▁ x", "in er on re \n\t", "0123456789abcdef", "=-_"]
    for i in range(count):
        kind = draw.choice(kinds)
        if i % 3:
            yield "".join(draw.choice(kind) for _ in range(draw.randint(1, 150)))
        else:
            yield "".join(draw.choice(list(vocabulary.ids)) for _ in range(draw.randint(1, 25))).replace(SPACE, " ")


@pytest.mark.parametrize("size", [1, 3, 7, 20, 50, 1000])
def test_cut_texts_equal_the_library(vocabulary, size):
    library = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    for text in samples(vocabulary, 40 if size < 7 else 150):
        assert scanned(vocabulary, text, size)[0] == library.encode(text), text


@pytest.mark.parametrize("size", [5, 30, 1000])
def test_unigram_scores_equal_the_library(size):
    model = unigram_model()
    vocabulary, library = Vocabulary(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    score = lambda ids: sum(library.get_score(i) for i in ids)
    for text in samples(vocabulary, 60):
        ours, theirs = scanned(vocabulary, text, size)[0], library.encode(text)
        assert len(ours) == len(theirs) or abs(score(ours) - score(theirs)) < 1e-3
        assert abs(score(ours) - score(theirs)) < 1e-3, text


def test_the_product_is_associative(vocabulary):
    text = "unbrokenwordwithoutanyspacesinsideofittoparteverythingelse" * 3
    matrices = scanned(vocabulary, text, 9)[1]
    a, b, c = matrices[1:4]
    assert combine(combine(a, b), c) == combine(a, combine(b, c))


def test_stability_by_undoing_equals_merging(vocabulary):
    draw, pieces = random.Random(9), list(vocabulary.ids)
    for _ in range(4_000):
        left, right = draw.choice(pieces), draw.choice(pieces)
        assert vocabulary.stable(left, right) == (vocabulary._merged([*left, *right]) == [left, right])


def test_tables(spark, vocabulary):
    library = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    draw = random.Random(2)
    texts = [None, "", " ", "x", "same", "same", "tab\tnew\nline\r\x00", "long words " * 4_000, "nospace" * 3_000,
             "".join(draw.choice("abc  \n") for _ in range(20_000)), " " * 5_000, "😀" * 3_000, "y" * 1023, "y" * 1024]
    rows = [(None if i == 3 else min(i, 8), t) for i, t in enumerate(texts)] + [(8, "nospace" * 3_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit(1) for c in ("ids", "id", "mark", "number", "size")}
    )
    order = lambda r: (r[0] is None, r[0] or 0, r[2], r[1])
    wanted = sorted(((i, library.encode(t or ""), t or "") for i, t in rows), key=order)
    for back in (decode(encode(docs, MODEL, chunk=1024), MODEL), round_trip(docs, MODEL, chunk=1024)):
        assert sorted(map(tuple, back.collect()), key=order) == wanted
    assert encode(docs.limit(0), MODEL).count() == round_trip(docs.limit(0), MODEL).count() == 0


def test_whole_table_round_trip(spark, sf_dir):
    library = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    wanted = {r.doc_id: r.text for r in docs.collect()}
    for row in round_trip(docs, MODEL).collect():
        assert row.text == wanted.pop(row.doc_id) and row.ids == library.encode(row.text)
    assert not wanted
