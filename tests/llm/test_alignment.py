"""The spilled alignment against plain code with the tokenizers' own libraries."""

from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from conftest_llm import docs_of
from tidewatch.llm import alignment
from tidewatch.llm.batches import byte_alphabet

ODD = ["a" * 3000, " " * 700, "\n" * 90, "^" * 90, "漢" * 60, "<|endoftext|> x", "<s>hi</s>", "<unk>", "<0x41>", "▁", "x▁y", "  two  ",
       "\t\x0b\x0c\x1c\x85\xa0z", "é ﬁ", "\0a", "😀👍🏽", "don't I'LL we've", "﻿bom", "", None]


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model")), byte_alphabet()


def brute(sides, rows):
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of (doc_id, text) rows, and the counts."""
    a_side, b_side, alphabet = sides

    def ends(parts):
        return np.cumsum([len(p) for p in parts]).tolist()

    found, counts = [], Counter()
    for key, text in rows:
        a, b, groups, links = [], [], [], []
        if text:
            a, b = a_side.encode(" " + text, add_special_tokens=False).ids, b_side.encode(text)
            left = [bytes(alphabet[c] for c in a_side.id_to_token(i)) for i in a]
            right = [bytes([int(b_side.id_to_piece(i)[3:5], 16)]) if b_side.is_byte(i) else b_side.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if b"".join(left) == b"".join(right) == (" " + text).encode():
                end_a, end_b = ends(left), ends(right)
                i = j = 0
                for cut in sorted(set(end_a) & set(end_b)):
                    k, m = end_a.index(cut, i) + 1, end_b.index(cut, j) + 1
                    groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
                    links.append((a[k - 1], b[m - 1]))
                    i, j = k, m
            else:
                a, b = [], []
        counts.update(links)
        found.append((key, len(a), len(b), groups, links))
    most = {}
    for (a, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    rows = [(key, n_a, n_b, len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
             sha256(";".join(groups).encode()).hexdigest() if groups else "") for key, n_a, n_b, groups, links in found]
    return sorted(rows, key=repr), counts, most


def same(spark, sides, docs, rows):
    out = alignment.align_documents(docs)
    expected, counts, most = brute(sides, rows)
    assert sorted((tuple(r) for r in out.documents.collect()), key=repr) == expected
    assert {(r.a, r.b): (r.n_links, r.best) for r in out.pairs.collect()} == {k: (n, n == most[k[1]]) for k, n in counts.items()}


def test_documents_and_pairs(spark, sides, sf_dir):
    docs = docs_of(spark, sf_dir)
    same(spark, sides, docs, [(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows_and_a_radix_in_parts(spark, sides, make_docs, odd, monkeypatch):
    """Nulls, empty and long texts, repeated rows, clashing names; runs of few links, merged in several groups."""
    monkeypatch.setattr(alignment, "_GROUP_BYTES", 300)
    rows = [*((i, t) for i, t in enumerate(ODD)), (3, ODD[3]), (None, "the cat sat"), (None, "the cat sat")] * 3
    same(spark, sides, make_docs(rows, extra=True), rows)
    same(spark, sides, odd, [(r.doc_id, r.text) for r in odd.collect()])
    assert alignment.align_documents(odd.limit(0)).documents.count() == 0
    assert alignment.align_documents(odd.where("text IS NULL")).pairs.count() == 0


def test_runs_merge_to_counts():
    rng = np.random.default_rng(5)
    pairs, rows = (rng.integers(0, 40, 5000) << 16) | rng.integers(0, 30, 5000), rng.integers(0, 90, 5000)
    own = {}
    for part in range(7):
        for radix, run in alignment.runs_of(pairs[part::7], rows[part::7], 4):
            back = alignment.Run.unpack(run.pack())
            assert all((x == y).all() for x, y in zip(run, back)) and ((run.pairs >> 16) % 4 == radix).all()
            own.setdefault(radix, []).append(run.pack())
    found = {}
    for runs in own.values():
        p, n = alignment.merge(runs)
        assert (np.diff(p) > 0).all()
        found.update(zip(p.tolist(), n.tolist()))
        best = alignment.highest(p, n)
        for b in set((p >> 16).tolist()):
            of_b = (p >> 16) == b
            assert (best[of_b] == (n[of_b] == n[of_b].max())).all()
    assert found == Counter(pairs.tolist())


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_ids_are_the_library_s(text):
    tool = alignment.aligner(public_tokenizers.path(alignment.BYTE_MODEL), public_tokenizers.path(alignment.PIECE_MODEL))
    own = Tokenizer.from_file(public_tokenizers.path(alignment.BYTE_MODEL)) if not hasattr(tool, "own") else tool.own
    tool.own = own
    own.encode_special_tokens = True
    text = text.encode("utf-8", "replace").decode()
    assert tool.a.encode([text])[0] == own.encode(text, add_special_tokens=False).ids
