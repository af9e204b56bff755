import random
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from conftest_llm import docs_of
from tidewatch.llm import batches, packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


WORDS = packing.WordIds(public_tokenizers.path(packing.TOKENIZER))
WHOLE = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("aAbTS,.Σςİſ'st’1 \t\n\x0b\x1c\x85  é́漢<|endoftext|>😀."), max_size=60))
def test_words_give_the_ids_of_the_text(text):
    ids = np.frombuffer(WORDS.encode([text.encode()])[0], "<u4").tolist()
    assert ids == WHOLE.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x250, exclude_categories=["Cs"]), max_size=40))
def test_latin_words_give_the_ids_of_the_text(text):
    assert np.frombuffer(WORDS.encode([text.encode()])[0], "<u4").tolist() == WHOLE.encode(text, add_special_tokens=False).ids


def test_every_token_of_the_vocabulary():
    words, alphabet = [t.removesuffix("</w>") for t in WHOLE.get_vocab()], batches.byte_alphabet()
    words = [w for w in (bytes(alphabet[c] for c in w).decode("utf-8", "ignore") for w in words) if w.strip()]
    got = WORDS.encode([w.encode() for w in words])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [WHOLE.encode(w, add_special_tokens=False).ids for w in words]


def test_any_other_tokenizer_reads_whole_texts(make_docs):
    """A byte-level file keeps case and white space, so nothing may be derived from words."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = packing.pack(make_docs([(1, "Hello World. Again"), (2, None)]), tokenizer=path, with_ids=True).collect()
    own = Tokenizer.from_file(path).encode("Hello World. Again", add_special_tokens=False).ids
    assert {r.doc_id: list(r.ids) for r in rows} == {1: [*own, 1], 2: [1]}


def one_by_one(lengths, capacity):
    """Best-fit decreasing on the pieces themselves; the rooms left."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        room = min(fits) if fits else capacity
        if fits:
            rooms.remove(room)
        rooms.append(room - n)
    return Counter(rooms)


def rooms_of(slots, capacity):
    used = Counter()
    for s in slots:
        for rank in range(s.first, s.last):
            at, place = divmod(rank - s.first, s.each)
            assert used[s.sequence + at] == s.offset + place * s.length
            used[s.sequence + at] += s.length
    return Counter(capacity - u for u in used.values())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80), st.integers(40, 64))
def test_plan_equals_best_fit(lengths, capacity):
    slots = packing.plan(Counter(lengths), capacity)
    assert rooms_of(slots, capacity) == one_by_one(lengths, capacity)
    for n, count in Counter(lengths).items():
        spans = sorted((s.first, s.last) for s in slots if s.length == n)
        assert spans[0][0] == 0 and spans[-1][1] == count and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_plan_stays_small():
    rng = random.Random(1)
    counts = {n: rng.randrange(1, 10**6) for n in range(1, 4097)}
    assert len(packing.plan(counts)) < 120_000


def check(rows, expected, capacity):
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == expected
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def pieces_of(tokenizer, docs, capacity):
    out = set()
    for d, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out |= {(d, k, k * capacity, len(part), crc32(part.tobytes())) for k, part in enumerate(
            ids[lo:lo + capacity] for lo in range(0, len(ids), capacity))}
    return out


def test_documents_against_brute_force(spark, sf_dir, tokenizer):
    docs = [(r.doc_id, r.text) for r in docs_of(spark, sf_dir).collect()]
    for capacity in (4096, 300):
        expected = pieces_of(tokenizer, docs, capacity)
        rows = packing.pack(docs_of(spark, sf_dir), capacity=capacity).collect()
        assert len(rows) == len(expected)
        n = check(rows, expected, capacity)
        assert n == sum(one_by_one([p[3] for p in expected], capacity).values())
        assert n <= 1.02 * sum(p[3] for p in expected) / capacity + 1


def test_many_rank_groups(spark, sf_dir, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "RANK_GROUP_ROWS", 7)
    docs = [(r.doc_id, r.text) for r in docs_of(spark, sf_dir).collect()]
    check(packing.pack(docs_of(spark, sf_dir)).collect(), pieces_of(tokenizer, docs, 4096), 4096)


def test_sequences_hold_the_ids(make_docs, tokenizer):
    placed = packing.pack(make_docs([(1, "one two three"), (2, None), (3, "four " * 30)]), capacity=10, with_ids=True)
    rows = packing.sequences(placed).collect()
    assert all(len(r.ids) <= 10 for r in rows)
    assert Counter(i for r in rows for i in r.ids) == Counter(
        [*tokenizer.encode("one two three" + " four" * 30).ids, 1, 1, 1])


def test_odd_rows(odd):
    rows = packing.pack(odd).collect()
    assert Counter(r.doc_id for r in rows if r.piece == 0) == Counter([1, 2, 3, 4, 5, 5, None, None, 6, 7])
    assert max(r.length for r in rows) == 4096 and {r.length for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert packing.pack(odd.limit(0)).count() == 0
