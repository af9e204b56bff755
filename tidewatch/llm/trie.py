"""Prefix tries of conversations as double arrays, a trie per prefix shard.

A turn is known by a digest of its role and text. Conversations with the same turns
are one sequence with a count. Sequences are sharded by their first turn, or
by as many turns as it takes to split a shard that is too large; each shard
packs BASE and CHECK arrays over dense turn ids and is traversed for its nodes.
Nodes above the split are shared by shards: their sums are merged over all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidewatch.llm.tables import store

#: Turns of distinct sequences that are packed into one double array, about.
SHARD_TURNS = 100_000
_WORDS = r"[^\x20\x09-\x0D]+"
_EMPTY = sha256(b"").hexdigest()
_FREE = -1


def turn_digests(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, place, a, b, words): a row per turn with its place from 1, a digest of 128 bits and its words.

    Turns are ordered by number, a null first; equal numbers by digest. A null
    role or text is an empty one. Rows without a conversation are left out.
    """
    said, body = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.sha2(F.concat(F.length(said).cast("string"), F.lit(":"), said, body), 256)

    def part(start: int) -> Column:  # 60 bits, which fit a long
        return F.conv(F.substring(digest, start, 15), 16, 10).cast("long")

    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), part(1).alias("a"), part(16).alias("b"),
        F.regexp_count(body, F.lit(_WORDS)).cast("long").alias("words"))
    order = W.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "a", "b")
    return rows.withColumn("place", F.row_number().over(order)).select("conv", "place", "a", "b", "words")


def sequences(digests: DataFrame) -> DataFrame:
    """(conv, a, b, words): every conversation's digests and words in order; its digests must fit a task's memory."""
    parts = F.array_sort(F.collect_list(F.struct("place", "a", "b", "words")))
    return digests.groupBy("conv").agg(parts.alias("t")).select("conv", *[F.col("t")[c].alias(c) for c in ("a", "b", "words")])


class DoubleArray(NamedTuple):
    """A trie packed into two arrays: the child of slot s by code c is slot BASE[s] + c if CHECK there is s. Slot 0 is the root."""

    base: np.ndarray
    check: np.ndarray

    def step(self, slots: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The children by these codes; every one must be there."""
        at = self.base[slots] + codes
        if len(at) and not (self.check[at] == slots).all():
            raise KeyError("not in the trie")
        return at


def pack(codes: np.ndarray, begin: np.ndarray, size: np.ndarray) -> DoubleArray:
    """The double array of sequences, given as slices of ``codes`` (dense from 0).

    Level by level: an only child takes the first free slot, several children the
    first gap that has room for all, sought in the first free slots, or the end.
    A base may be negative; a slot never is.
    """
    n = len(codes)
    width = int(codes.max(initial=0)) + 1
    base, check = np.zeros(n + width + 2, np.int64), np.full(n + width + 2, _FREE, np.int64)
    check[0] = 0
    end, hole = 1, 1  # slots from ``end`` on are free, those before ``hole`` are not
    slot, live, depth = np.zeros(len(size), np.int64), np.flatnonzero(size > 0), 0
    while len(live):
        code = codes[begin[live] + depth]
        edges, back = np.unique(slot[live] * width + code, return_inverse=True)
        parents, child = edges // width, edges % width
        first = np.flatnonzero(np.diff(parents, prepend=-1))
        count = np.diff(np.append(first, len(parents)))
        at = np.empty(len(edges), np.int64)
        for f, k in zip(first[count > 1].tolist(), count[count > 1].tolist()):
            own = child[f:f + k]
            free = hole + np.flatnonzero(check[hole:end] == _FREE)[:64]
            starts = [int(s) for s in free if end <= s + own[-1] - own[0] < len(check) or s + own[-1] - own[0] < end]
            start = next((s for s in starts if (_free(check, s + own - own[0])).all()), end)
            places = start + own - own[0]
            if places[-1] >= len(check):
                base, check = _grown(base, 0, places[-1] + 1), _grown(check, _FREE, places[-1] + 1)
            check[places], base[parents[f]] = parents[f], start - own[0]
            at[f:f + k] = places
            end = max(end, int(places[-1]) + 1)
        only = first[count == 1]
        if len(only):
            holes = hole + np.flatnonzero(check[hole:end] == _FREE)[:len(only)]
            more = len(only) - len(holes)
            if end + more > len(check):
                base, check = _grown(base, 0, end + more), _grown(check, _FREE, end + more)
            places = np.concatenate([holes, np.arange(end, end + more)])
            check[places], base[parents[only]] = parents[only], places - child[only]
            at[only] = places
            end += more
            hole = int(holes[-1]) + 1 if more == 0 else end
        slot[live] = at[back]
        depth += 1
        live = live[size[live] > depth]
    return DoubleArray(base[:end], check[:end])


def _free(check: np.ndarray, places: np.ndarray) -> np.ndarray:
    return check[np.minimum(places, len(check) - 1)] == _FREE


def _grown(values: np.ndarray, fill: int, least: int) -> np.ndarray:
    return np.concatenate([values, np.full(max(least, 2 * len(values)) - len(values), fill, np.int64)])


def _mixed(state: np.ndarray, digest: np.ndarray, odd: int) -> np.ndarray:
    """One lane of a node's key: its parent's key and its turn's digest, stirred."""
    with np.errstate(over="ignore"):
        x = (state.astype(np.uint64) * np.uint64(odd)) ^ (digest.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return (x ^ (x >> np.uint64(31))).view(np.int64)


_NODE = ("upper boolean, depth long, conv long, n_convs long, n_children long, n_leaves long, saved long, words long, "
         "k1 long, k2 long, p1 long, p2 long, parent_conv long, e1 long, e2 long, path1 array<long>, path2 array<long>")


def shard_nodes(split: np.ndarray, conv: np.ndarray, count: np.ndarray, ends: tuple[np.ndarray, np.ndarray],
                size: np.ndarray, a: np.ndarray, b: np.ndarray, words: np.ndarray) -> pa.RecordBatch:
    """The nodes of one shard's trie: distinct sequences as slices of ``a``, ``b`` and ``words``.

    ``split`` is the depth from which a sequence's nodes are in no other shard. Nodes above are
    ``upper``: their sums are partial, and neither they nor their own savings are counted in them.
    """
    begin = np.cumsum(size) - size
    order = np.lexsort((b, a))
    fresh = np.ones(len(a), bool)
    fresh[1:] = (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)
    codes = np.empty(len(a), np.int64)
    codes[order] = np.cumsum(fresh) - 1
    array = pack(codes, begin, size)

    slots = len(array.check)
    n_convs, least = np.zeros(slots, np.int64), np.full(slots, np.iinfo(np.int64).max)
    depth_of, own_words, upper = np.full(slots, -1, np.int64), np.zeros(slots, np.int64), np.zeros(slots, bool)
    k1, k2 = np.zeros(slots, np.int64), np.zeros(slots, np.int64)
    e1, e2, ended = np.zeros(slots, np.int64), np.zeros(slots, np.int64), np.zeros(slots, bool)
    levels, slot, live, depth = [], np.zeros(len(size), np.int64), np.arange(len(size)), 0
    while len(live):
        if depth:
            turn = begin[live] + depth - 1
            before = slot[live]
            slot[live] = now = array.step(before, codes[turn])
            own_words[now] = words[turn]
            k1[now], k2[now] = _mixed(k1[before], a[turn], 0xD6E8FEB86659FD93), _mixed(k2[before], b[turn], 0xCA5A826395121157)
        now = slot[live]
        levels.append(np.unique(now))
        depth_of[now] = depth
        upper[now] |= depth < split[live]
        np.add.at(n_convs, now, count[live])
        np.minimum.at(least, now, conv[live])
        done = size[live] == depth
        e1[now[done]], e2[now[done]], ended[now[done]] = ends[0][live[done]], ends[1][live[done]], True
        live = live[~done]
        depth += 1

    nodes = np.concatenate(levels)
    parent = array.check
    children, leaves, saved = np.zeros(slots, np.int64), np.zeros(slots, np.int64), np.zeros(slots, np.int64)
    for level in levels[:0:-1]:
        lower = level[~upper[level]]
        leaves[lower] += children[lower] == 0
        saved[lower] += (n_convs[lower] - 1) * own_words[lower]
        np.add.at(children, parent[lower], 1)
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    top = parent[nodes]
    shared = upper[nodes]
    below_upper = upper[top]
    paths = ([], [])
    for at in nodes.tolist():
        if not upper[at]:
            for path in paths:
                path.append(None)
            continue
        line = []
        while True:
            line.append(at)
            if at == 0:
                break
            at = int(parent[at])
        paths[0].append(k1[line])
        paths[1].append(k2[line])
    none = lambda values, where: pa.array(values, pa.int64(), mask=where)
    return pa.RecordBatch.from_arrays(
        [pa.array(shared), *[pa.array(v[nodes]) for v in (depth_of, least, n_convs, children, leaves, saved, own_words, k1, k2)],
         none(k1[top], nodes == 0), none(k2[top], nodes == 0), none(least[top], below_upper),
         none(e1[nodes], ~ended[nodes]), none(e2[nodes], ~ended[nodes]), *[pa.array(p, pa.list_(pa.int64())) for p in paths]],
        [c.split()[0] for c in _NODE.split(", ")])


def _list(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and values of a list column."""
    return np.diff(column.offsets.to_numpy()), column.flatten().to_numpy(zero_copy_only=False)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of each shard; rows come sorted by shard, and one shard's rows are held at a time."""
    held, number = [], None
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)] if len(shard) else []
        for lo, hi in zip(cuts, cuts[1:]):
            if held and shard[lo] != number:
                yield _packed(held)
                held = []
            number = shard[lo]
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield _packed(held)


def _packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(held).combine_chunks()
    column = lambda name: rows.column(name).combine_chunks()
    size, a = _list(column("a"))
    split, conv, n, g1, g2 = (column(c).to_numpy().astype(np.int64) for c in ("split", "conv", "n", "g1", "g2"))
    return shard_nodes(split, conv, n, (g1, g2), size.astype(np.int64), a, _list(column("b"))[1], _list(column("words"))[1])


def _prefix(depth: int) -> Column:
    return F.xxhash64(F.slice("a", 1, depth), F.slice("b", 1, depth))


def split_depths(distinct: DataFrame, shard_turns: int) -> DataFrame:
    """``distinct`` with ``prefix`` and ``split``: the depth, doubled while needed, at which a sequence's group is small enough.

    A group holds the sequences with the same first ``split`` turns. One that is too
    large has sequences that go on (copies are one sequence), so it can be split.
    """
    settled, rest, depth = None, distinct, 1
    while True:
        keyed = rest.withColumn("prefix", _prefix(depth)).withColumn("split", F.lit(depth))
        heavy = store(keyed.groupBy("prefix").agg(F.sum(F.size("a")).alias("turns"), F.max(F.size("a")).alias("longest"),
                                                  F.count(F.lit(1)).alias("n")).where(
            (F.col("turns") > shard_turns) & (F.col("longest") > depth) & (F.col("n") > 1)).select("prefix"), "heavy")
        if heavy.df.isEmpty():
            return keyed if settled is None else settled.union(keyed)
        done = keyed.join(heavy.df, "prefix", "left_anti").select(*keyed.columns)
        settled = done if settled is None else settled.union(done)
        rest = store(keyed.join(heavy.df, "prefix", "left_semi").select(*distinct.columns), "rest").df
        depth *= 2


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each group's conversation numbers, streamed; rows come sorted by group and number."""
    group, state, out = None, None, []
    for batch in batches:
        keys = list(zip(batch.column("g1").to_pylist(), batch.column("g2").to_pylist()))
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)] if keys else []
        numbers = batch.column("conv").to_pylist()
        for lo, hi in zip(cuts, cuts[1:]):
            body = ",".join(map(str, numbers[lo:hi])).encode()
            if keys[lo] == group:
                state.update(b"," + body)
            else:
                if state:
                    out.append((*group, state.hexdigest()))
                group, state = keys[lo], sha256(body)
        if len(out) > 10_000:
            yield _digests(out)
            out = []
    if state:
        out.append((*group, state.hexdigest()))
    yield _digests(out)


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))], ["e1", "e2", "ends_sha256"])


def prefix_trie(sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Every node of the trie of ``sequences`` (conv, a, b, words): its members, place and sums over its subtree.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256); see :func:`sequences`.
    A conversation without turns is a member of the root alone; without any
    conversation there is no root. Equal conversations count one by one, as do equal numbers.
    """
    keyed = store(sequences.select("conv", "a", "b", "words", F.xxhash64("a").alias("g1"), F.xxhash64("b", F.size("a")).alias("g2")),
                  "sequences").df
    ends = keyed.select("g1", "g2", "conv").repartition("g1", "g2").sortWithinPartitions("g1", "g2", "conv").mapInArrow(
        _members, "e1 long, e2 long, ends_sha256 string")
    distinct = store(keyed.groupBy("a", "b").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n"), F.first("words").alias("words"),
                                                 F.first("g1").alias("g1"), F.first("g2").alias("g2")), "distinct").df
    turns = distinct.agg(F.sum(F.size("a"))).first()[0] or 0
    shards = max(1, -(-turns // shard_turns))
    dealt = split_depths(distinct, shard_turns).withColumn("shard", F.pmod("prefix", F.lit(shards)).cast("int"))
    columns = ["shard", "split", "conv", "n", "g1", "g2", "a", "b", "words"]
    nodes = store(dealt.select(*columns).repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(_shards, _NODE), "nodes").df

    upper = nodes.where("upper").groupBy("k1", "k2", "depth").agg(
        F.min("conv").alias("conv"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
        *[F.first(c, ignorenulls=True).alias(c) for c in ("words", "p1", "p2", "e1", "e2", "path1", "path2")])
    upper = store(upper, "upper").df
    more = upper.where("p1 IS NOT NULL").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("more"))
    counted = store(upper.join(more, ["k1", "k2"], "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).drop("more"), "counted").df
    own = counted.select(
        F.explode(F.arrays_zip("path1", "path2")).alias("p"), (F.col("n_children") == 0).cast("long").alias("leaf"),
        F.when(F.col("depth") > 0, (F.col("n_convs") - 1) * F.col("words")).otherwise(0).alias("own"))
    sums = own.groupBy(F.col("p.path1").alias("k1"), F.col("p.path2").alias("k2")).agg(F.sum("leaf").alias("leaf"), F.sum("own").alias("own"))
    merged = store(counted.join(sums, ["k1", "k2"]).withColumn("n_leaves", F.col("n_leaves") + F.col("leaf")).withColumn(
        "saved", F.col("saved") + F.col("own")), "merged").df

    known = merged.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("above"))
    shown = ["conv", "depth", "parent_conv", "n_convs", "n_children", "n_leaves", "saved", "e1", "e2"]
    lower = nodes.where("NOT upper")
    below = lower.where("parent_conv IS NULL").drop("parent_conv").join(known, ["p1", "p2"]).withColumnRenamed("above", "parent_conv")
    highest = merged.join(known, ["p1", "p2"], "left").withColumnRenamed("above", "parent_conv")
    every = lower.where("parent_conv IS NOT NULL").select(*shown).union(below.select(*shown)).union(highest.select(*shown))
    every = store(every, "every").df
    with_ends = every.where("e1 IS NOT NULL").join(ends, ["e1", "e2"]).select(*shown[:7], "ends_sha256")
    without = every.where("e1 IS NULL").select(*shown[:7], F.lit(_EMPTY).alias("ends_sha256"))
    return with_ends.union(without).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), "ends_sha256")


def share_openings(digests: DataFrame, most: int = 4, among: int = 20) -> DataFrame:
    """Sequences of conversations rebuilt with another one's opening.

    Conversation c gets the first h turns of conversation c - c % ``among`` (as many as it has), then
    its own turns after its first h, h being crc32 of c's decimal digits modulo ``most``.
    """
    opening = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(most))
    own = sequences(digests).withColumn("h", opening.cast("int")).withColumn("donor", F.col("conv") - F.col("conv") % among)
    donors = sequences(digests.where((F.col("conv") % among == 0) & (F.col("place") < most)))
    donors = donors.select(F.col("conv").alias("donor"), *[F.col(c).alias(f"{c}0") for c in ("a", "b", "words")])
    none = F.array().cast("array<long>")
    rebuilt = own.join(donors, "donor", "left").select("conv", *[
        F.concat(F.coalesce(F.slice(f"{c}0", F.lit(1), F.col("h")), none),
                 F.slice(c, F.col("h") + 1, F.greatest(F.size(c) - F.col("h"), F.lit(0)))).alias(c) for c in ("a", "b", "words")])
    return rebuilt
