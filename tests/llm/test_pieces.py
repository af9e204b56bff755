import random

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from sentencepiece import SentencePieceProcessor

from conftest_llm import docs_of
from tidewatch.llm import pieces

PATH = public_tokenizers.path(pieces.MODEL)
MODEL = SentencePieceProcessor(model_file=PATH)
ENCODER = pieces.Encoder(PATH)
DECODER = pieces.Decoder(PATH)


def ids_of(texts):
    return [np.frombuffer(b, "<u4").tolist() for b in ENCODER.encode(texts)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abcdehinorstuy   \n\t▁é漢ゼ01.,'\0😀"), max_size=50), max_size=6))
def test_equal_to_the_library(texts):
    assert ids_of(texts) == [MODEL.encode(t) for t in texts]


def test_glued_pieces_equal_the_library():
    rng = random.Random(5)
    known = list(ENCODER.vocabulary.index)
    texts = ["".join(rng.choice(known).replace("▁", rng.choice(["", " "])) for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    texts += ["a" * n for n in range(1, 40)] + ["the" * 700, " " * 300, "\n" * 5, "</s><s><0x41>"]
    assert ids_of(texts) == [MODEL.encode(t) for t in texts]
    assert [DECODER.decode(i).decode("utf-8", "replace") for i in ids_of(texts)] == [MODEL.decode(MODEL.encode(t)) for t in texts]


def test_occurrences_by_search():
    rng = random.Random(2)
    text = "".join(rng.choice("abc\0") for _ in range(400))
    words = sorted({text[i:i + n] for i in range(0, 390, 7) for n in (1, 2, 5, 9) if "\0" not in text[i:i + n]} | {"zz", "aaaaaaaab"})
    codes = np.zeros((len(words), 9), np.uint32)
    for row, w in zip(codes, words):
        row[:len(w)] = list(map(ord, w))
    start, row = pieces.occurrences(np.array(list(map(ord, text)), np.uint32), codes)
    expected = {(i, k) for k, w in enumerate(words) for i in range(len(text)) if text.startswith(w, i)}
    assert set(zip(start.tolist(), row.tolist())) == expected and len(start) == len(expected)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(pieces, "_CACHED_SEGMENTS", 3)
    monkeypatch.setattr(pieces, "_CACHED_LENGTH", 4)
    monkeypatch.setattr(pieces, "_BATCH_CHARS", 20)
    texts = ["one two three four", "five six one two", "extraordinarily long words", ""] * 2
    fresh = pieces.Encoder(PATH)
    for _ in range(3):
        assert [np.frombuffer(b, "<u4").tolist() for b in fresh.encode(texts)] == [MODEL.encode(t) for t in texts]


def test_documents_round_trip(spark, sf_dir):
    docs = {r.doc_id: r.text for r in docs_of(spark, sf_dir).collect()}
    encoded = pieces.encode_documents(docs_of(spark, sf_dir))
    assert {r.doc_id: r.ids for r in encoded.collect()} == {d: MODEL.encode(t) for d, t in docs.items()}
    assert {r.doc_id: r.decoded for r in pieces.decode_documents(encoded).collect()} == docs


def test_odd_rows(odd):
    rows = pieces.decode_documents(pieces.encode_documents(odd)).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in rows) == sorted((str(r.doc_id), r.text or "") for r in odd.collect())
    assert pieces.encode_documents(odd.limit(0)).count() == 0
