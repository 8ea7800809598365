"""SentencePiece encoding and decoding against the library."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from gridmill.llm import pieces

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path(pieces.MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def codec():
    with open(MODEL, "rb") as f:
        return pieces.Codec(f.read())


def hostile(library):
    random.seed(4)
    vocabulary = [library.id_to_piece(i) for i in range(259, library.get_piece_size())]
    parts = ["the ", "  ", "▁", "é漢", "\n", "12", "Christ", "conceorted", "sen", "　", "😀", "​", "é", "<s>", "</s>", "<unk>", "<0x41>", "\x00", "ﬁ", " "]
    texts = ["", " ", "   ", None, "  x ", "\n\n hi", "▁a▁b", "\x00z", " " * 1500, "a" * 3000, " " * 100 + "x" + " " * 77, "thethe" * 400, "é" * 700, "漢" * 600]
    for _ in range(1500):
        texts.append("".join(random.choice(random.choice([parts, vocabulary, list("etaoin shrdlu")])) for _ in range(random.randint(0, 60))))
    return texts + ["".join(random.choice(vocabulary).replace("▁", "") for _ in range(900)) for _ in range(20)]


@pytest.mark.parametrize("window", [4 << 20, 700])
def test_ids_are_the_librarys(library, codec, monkeypatch, window):
    monkeypatch.setattr(pieces, "WINDOW", window)
    texts = hostile(library)
    ids, counts = pieces._rows(codec, pa.array(texts))
    want = library.encode([t or "" for t in texts])
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]
    assert [t.decode() for t in codec.decode(ids, counts)] == library.decode(want)


def test_long_segments_go_the_same_way(library, codec, monkeypatch):
    monkeypatch.setattr(pieces, "LONG", 3)
    texts = hostile(library)[:400]
    ids, _ = pieces._rows(codec, pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in library.encode(t or "")]


def test_any_ids_decode_as_in_the_library(library, codec):
    random.seed(5)
    rows = [[random.choice([random.randrange(32000), random.randrange(259)]) for _ in range(random.randint(0, 12))] for _ in range(4000)]
    got = codec.decode(np.array([i for r in rows for i in r], np.int32), np.array([len(r) for r in rows]))
    assert [g.decode() for g in got] == library.decode(rows)


def test_long_texts_take_time_in_proportion(codec):
    import time

    began = time.time()
    for text in ("0123456789" * 100_000, "a" * 500_000, " " * 300_000, "word " * 400_000):
        ids, counts = pieces._rows(codec, pa.array([text]))
        assert codec.decode(ids, counts) == [text.encode()]
    assert time.time() - began < 60


def test_frames(spark, library):
    rows = [(1, "Hello  there", 7), (1, "Hello  there", 7), (None, None, 8), (3, "", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    model = pieces.load_model(spark, MODEL)
    out = pieces.encode_documents(docs.drop("ids").withColumnRenamed("doc_id", "n_tokens"), model)
    assert sorted((r[0] or 0, r.ids) for r in out.collect()) == sorted((i or 0, library.encode(t or "")) for i, t, _ in rows)
    back = pieces.decode_documents(out.drop("text"), model)
    assert sorted(r.text for r in back.collect()) == sorted(t or "" for _, t, _ in rows)
    named = docs.selectExpr("concat('d', doc_id) AS doc_id", "text", "ids AS n_tokens")
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in pieces.digests(named, model).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {(i and f"d{i}", len(x := library.encode(t or "")), sha(",".join(map(str, x))), sha(library.decode(x))) for i, t, _ in rows}
    assert pieces.digests(docs.limit(0), model).count() == 0


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        pieces.Codec(b"")
