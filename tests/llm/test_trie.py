"""Double-array tries against plain code."""

import random
import re
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tidewatch.llm import trie
from tidewatch.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rebuilt(rows):
    """Conversations as lists of (role, text), with openings shared; rows have at most one turn of a number."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(role, text) for _, _, role, text in sorted(turns)] for c, turns in own.items()}
    opening = {c: crc32(str(c).encode()) % 4 for c in own}
    return {c: own.get(c - c % 20, [])[:opening[c]] + turns[opening[c]:] for c, turns in own.items()}


def brute(convs):
    nodes, kids, saved, leaves = {}, {}, {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    for k in nodes:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    for k in sorted(nodes, key=len, reverse=True):
        saved[k] = sum(saved[x] for x in kids.get(k, [])) + ((len(nodes[k]) - 1) * len(WORD.findall(k[-1][1])) if k else 0)
        leaves[k] = sum(leaves[x] for x in kids[k]) if k in kids else 1
    ends = {k: ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(k)) for k, m in nodes.items()}
    return sorted(((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), len(kids.get(k, [])), leaves[k], saved[k],
                    sha256(ends[k].encode()).hexdigest()) for k, m in nodes.items()), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def turns_of(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.selectExpr("*", *[f"'x' AS {c}" for c in ("conv", "place", "a", "b", "words", "shard", "depth", "n")]) if extra else df


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op12_prefix_trie"](spark, sf_dir)) == brute(rebuilt(rows))


@pytest.mark.parametrize("shard_turns", [100_000, 20, 3])
def test_shared_prefixes_nulls_and_splits(spark, shard_turns):
    """Few turns, so that most prefixes are shared; small shards split their groups again and again."""
    r = random.Random(1)
    rows = [(c, t, r.choice(["user", "assistant", None]), r.choice(["x", "y z", None, "w\x0bw w", "ünï 漢字 "]))
            for c in range(100) for t in r.sample([None, *range(9)], r.randrange(0, 7))]
    rows += [(None, 1, "user", "nobody"), (None, None, None, None)]
    got = trie.prefix_trie(trie.share_openings(trie.turn_digests(turns_of(spark, rows, extra=True))), shard_turns)
    assert found(got) == brute(rebuilt(rows))


def test_copies_a_long_conversation_and_deep_sharing(spark):
    same = [(c, t, "user", f"turn {t}") for c in range(1000, 1080) for t in range(6)]
    long = [(7, t, "assistant", "on and on") for t in range(3000)]
    forks = [(c, t, "user", f"go {t}" if t < 9 else f"{c}") for c in range(2000, 2040) for t in range(11)]
    rows = same + long + forks
    digests = trie.turn_digests(turns_of(spark, rows))
    plain = {}
    for c, _, role, text in sorted(rows):
        plain.setdefault(c, []).append((role, text))
    assert found(trie.prefix_trie(trie.sequences(digests), 30)) == brute(plain)
    assert found(trie.prefix_trie(trie.share_openings(digests))) == brute(rebuilt(rows))


def test_empty_table_and_repeated_rows(spark):
    assert trie.prefix_trie(trie.share_openings(trie.turn_digests(turns_of(spark, [])))).count() == 0
    rows = [(20, 0, "user", "hi")] * 3 + [(1, None, None, None)]
    got = trie.prefix_trie(trie.sequences(trie.turn_digests(turns_of(spark, rows))))
    assert found(got) == brute({20: [("user", "hi")] * 3, 1: [("", "")]})


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), max_size=6), min_size=1, max_size=40))
def test_double_array(sequences):
    """Every prefix has a slot of its own, and no other transition exists."""
    alphabet = {v: i for i, v in enumerate(sorted({x for s in sequences for x in s}))}
    codes = np.array([alphabet[x] for s in sequences for x in s], np.int64)
    size = np.array(list(map(len, sequences)), np.int64)
    array = trie.pack(codes, np.cumsum(size) - size, size)
    slots = {(): 0}
    for s in sequences:
        at = 0
        for d, x in enumerate(s):
            at = int(array.step(np.array([at]), np.array([alphabet[x]]))[0])
            assert slots.setdefault(tuple(s[:d + 1]), at) == at
    assert len(set(slots.values())) == len(slots) == int((array.check != -1).sum())
    for prefix, at in slots.items():
        for x, code in alphabet.items():
            to = int(array.base[at]) + code
            there = 0 < to < len(array.check) and array.check[to] == at and (*prefix, x) in slots
            assert there == ((*prefix, x) in slots)
