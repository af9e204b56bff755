"""Alignment of two tokenizers by external spill counting.

Tasks tokenize whole texts with both tokenizers and link tokens that end at the
same byte. The pair-document records of some megabytes of text are sorted side-major,
by the second tokenizer's id, and cut by the low bits of that id into
zstd-compressed runs, which are stored once. A task per radix merges its runs
through a heap of their heads and counts each pair; a second pass over the same
runs has all counts of an id at hand in side-major order, takes their
maximum, and streams each record's share back to its document.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from sentencepiece import SentencePieceProcessor

from tidewatch.llm.batches import blocks, byte_alphabet
from tidewatch.llm.tables import store

BYTE_MODEL = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"
#: Fixed value: the pre-tokenizer's published pattern.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Ids of the first tokenizer fit into so many bits of a pair.
SIDE_BITS = 16
RADICES = 16
#: Text that is encoded together, links that make a run, and compressed runs that are merged together.
_BLOCK_BYTES = 1_000_000
_RUN_LINKS = 2_000_000
_GROUP_BYTES = 48_000_000


class Side(NamedTuple):
    """One tokenizer: each id's bytes, their number, and the id as text."""

    encode: object
    token_bytes: list[bytes]
    sizes: np.ndarray


def byte_side(path: str) -> Side:
    """A byte-level vocabulary file with the published pattern; ids must follow the order of its merges."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, alphabet = spec["model"], byte_alphabet()
    if spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
        raise ValueError("only a byte-level model without normalisation and added space is supported")
    special = {t["content"] for t in spec["added_tokens"]}
    ranks = {bytes(map(alphabet.__getitem__, token)): i for token, i in model["vocab"].items() if token not in special}
    made = [ranks[bytes(map(alphabet.__getitem__, a + b))] for a, b in model["merges"]]
    if made != sorted(made):
        raise ValueError("ids do not follow the order of the merges")
    coder = tiktoken.Encoding("bytes", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})
    token_bytes = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        token_bytes[i] = token
    return Side(lambda texts: list(map(coder.encode_ordinary, texts)), token_bytes, np.array(list(map(len, token_bytes))))


def piece_side(path: str) -> Side:
    """A piece model file; U+2581 stands for a space and ``<0xHH>`` for a byte."""
    model = SentencePieceProcessor(model_file=path)
    pieces = map(model.id_to_piece, range(model.vocab_size()))
    token_bytes = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    return Side(lambda texts: model.encode(texts, num_threads=1), token_bytes, np.array(list(map(len, token_bytes))))


class Tokenized(NamedTuple):
    """Texts of a block: ids of both sides one after another, and the number of ids per text."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray


class Aligner:
    """Both tokenizers and the tables to write groups down."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        self.a, self.b = byte_side(byte_path), piece_side(piece_path)
        if max(len(self.a.token_bytes), len(self.b.token_bytes)) > 1 << SIDE_BITS:
            raise ValueError("ids need more bits")
        # an id of either side as it is written inside a group, at the end of a side, at the end of a group
        self.written = [f"{i}{end}".encode() for i in range(max(len(self.a.token_bytes), len(self.b.token_bytes))) for end in ",|;"]

    def tokenize(self, texts: Sequence[str | None]) -> Tokenized:
        """Ids of both sides; none where a side's bytes are not those of a space and the text."""
        whole = [i for i, t in enumerate(texts) if t]
        left, right = self.a.encode([" " + texts[i] for i in whole]), self.b.encode([texts[i] for i in whole])
        n_a, n_b = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        ids_a, ids_b = [], []
        for i, a, b in zip(whole, left, right):
            body = b" " + texts[i].encode()
            if b"".join(map(self.a.token_bytes.__getitem__, a)) == body == b"".join(map(self.b.token_bytes.__getitem__, b)):
                n_a[i], n_b[i] = len(a), len(b)
                ids_a += a
                ids_b += b
        return Tokenized(np.array(ids_a, np.int64), np.array(ids_b, np.int64), n_a, n_b)

    def align(self, t: Tokenized) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """(groups per text, pair of each link, text of each link, digest of each text's groups).

        Both sides of a text have the same bytes, so ends can be counted through
        all texts. A pair is the second id shifted by ``SIDE_BITS`` plus the first.
        """
        end_a, end_b = np.cumsum(self.a.sizes[t.a]), np.cumsum(self.b.sizes[t.b])
        met = np.searchsorted(end_a, end_b)
        shared = end_a[met] == end_b if len(end_a) else np.zeros(0, bool)
        last_a = np.zeros(len(t.a), bool)
        last_a[met[shared]] = True
        text_of_b = np.repeat(np.arange(len(t.n_b)), t.n_b)
        text = text_of_b[shared]
        pairs = (t.b[shared] << SIDE_BITS) | t.a[met[shared]]
        groups = np.bincount(text, minlength=len(t.n_b))

        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(shared) - shared
        until_a = np.append(0, np.flatnonzero(last_a) + 1)  # tokens of a side before each group
        until_b = np.append(0, np.flatnonzero(shared) + 1)
        order = np.empty(len(t.a) + len(t.b), np.int64)
        order[np.arange(len(t.a)) + until_b[group_a]] = 3 * t.a + last_a
        order[np.arange(len(t.b)) + until_a[group_b + 1]] = 3 * t.b + 2 * shared
        digests, at = [], 0
        for n in (t.n_a + t.n_b).tolist():
            body = b"".join(map(self.written.__getitem__, order[at:at + n].tolist()))
            digests.append(sha256(body[:-1]).hexdigest() if n else "")
            at += n
        return groups, pairs, text, digests


@lru_cache
def aligner(byte_path: str, piece_path: str) -> Aligner:
    """One per Python worker."""
    return Aligner(byte_path, piece_path)


class Run(NamedTuple):
    """Records sorted by pair, then document: distinct pairs, links and documents of each, and the records."""

    pairs: np.ndarray
    links: np.ndarray
    spread: np.ndarray
    rows: np.ndarray
    counts: np.ndarray

    def pack(self) -> bytes:
        """Two zstd frames of little-endian columns, the distinct pairs (as differences) and the records; the first one's length in front."""
        head = _frame(np.diff(self.pairs, prepend=0), self.links)
        return len(head).to_bytes(8, "little") + head + _frame(self.spread, np.array([len(self.rows)]), self.rows, self.counts)

    @classmethod
    def unpack(cls, packed: bytes) -> Run:
        pairs, links = heads(packed)
        body = _columns(packed[8 + int.from_bytes(packed[:8], "little"):])
        n, m = len(pairs), int(body[len(pairs)])
        return cls(pairs, links, body[:n], body[n + 1:n + 1 + m], body[n + 1 + m:])


def _frame(*columns: np.ndarray) -> bytes:
    return zstandard.compress(b"".join(c.astype("<u4").tobytes() for c in columns), 3)


def _columns(frame: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(frame), "<u4").astype(np.int64)


def heads(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, links) of a packed run; its records stay packed."""
    both = _columns(packed[8:8 + int.from_bytes(packed[:8], "little")])
    n = len(both) // 2
    return np.cumsum(both[:n]), both[n:]


def runs_of(pairs: np.ndarray, rows: np.ndarray, radices: int = RADICES) -> Iterator[tuple[int, Run]]:
    """One sorted run per radix of the second side's id, from links given as pair and document."""
    records, counts = np.unique((pairs << 31) | rows, return_counts=True)
    pairs, rows = records >> 31, records & ((1 << 31) - 1)
    radix = (pairs >> SIDE_BITS) % radices
    for r in np.unique(radix).tolist():
        own = radix == r
        p, n = pairs[own], counts[own]
        first = np.flatnonzero(np.diff(p, prepend=-1))
        yield r, Run(p[first], np.add.reduceat(n, first), np.diff(np.append(first, len(p))), rows[own], n)


def merge(runs: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, links) of packed runs, by a k-way heap merge of their sorted heads."""
    def stream(packed: bytes) -> Iterator[tuple[int, int]]:
        pairs, links = (c.astype(np.uint32) for c in heads(packed))
        for lo in range(0, len(pairs), 4096):  # few at a time as Python numbers
            yield from zip(pairs[lo:lo + 4096].tolist(), links[lo:lo + 4096].tolist())

    pairs, links, before = [], [], -1
    for pair, n in heapq.merge(*map(stream, runs)):
        if pair == before:
            links[-1] += n
        else:
            pairs.append(pair)
            links.append(n)
            before = pair
    return np.array(pairs, np.int64), np.array(links, np.int64)


def highest(pairs: np.ndarray, links: np.ndarray) -> np.ndarray:
    """Whether a pair's count is the highest of its second id; pairs come in side-major order."""
    if not len(pairs):
        return np.zeros(0, bool)
    first = np.flatnonzero(np.diff(pairs >> SIDE_BITS, prepend=-1))
    most = np.maximum.reduceat(links, first)
    return links == np.repeat(most, np.diff(np.append(first, len(pairs))))


def shares(run: Run, pairs: np.ndarray, links: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, links that are best, sum of counts) that a run gives back, one entry per document."""
    at = np.repeat(np.searchsorted(pairs, run.pairs), run.spread)
    rows, back = np.unique(run.rows, return_inverse=True)
    n_best, total = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    np.add.at(n_best, back, run.counts * best[at])
    np.add.at(total, back, run.counts * links[at])
    return rows, n_best, total


class Alignment(NamedTuple):
    """``documents`` (key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) and ``pairs`` (a, b, n_links, best)."""

    documents: DataFrame
    pairs: DataFrame


_SPILLED = "block long, row int, key {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, radix int, run binary"


def spill(docs: DataFrame, key: str, text: str, byte_path: str, piece_path: str) -> DataFrame:
    """Rows of two kinds, numbered by block: a document with its own figures, or a run of records (``radix`` set).

    A block is the documents of one run; its number holds the task's, so a task that is done again writes the same.
    """
    kind = docs.schema[key].dataType.simpleString()
    names = ["block", "row", "key", "n_a", "n_b", "n_groups", "groups_sha256", "radix", "run"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(byte_path, piece_path)
        block, row, pairs, rows, waiting = TaskContext.get().partitionId() << 32, 0, [], [], 0
        keys = None

        def flush() -> Iterator[pa.RecordBatch]:
            if waiting:
                found = [(r, part.pack()) for r, part in runs_of(np.concatenate(pairs), np.concatenate(rows))]
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, keys), *[pa.nulls(n, pa.int64())] * 3,
                     pa.nulls(n, pa.string()), pa.array([r for r, _ in found], pa.int32()), pa.array([p for _, p in found], pa.binary())], names)

        for batch in batches:
            keys = batch.column(0).type
            for lo, hi in blocks(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist(), _BLOCK_BYTES):
                tokenized = tool.tokenize(batch.column(1).slice(lo, hi - lo).to_pylist())
                groups, links, owner, digests = tool.align(tokenized)
                n = hi - lo
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * n, pa.int64()), pa.array(np.arange(row, row + n), pa.int32()), batch.column(0).slice(lo, n),
                     pa.array(tokenized.n_a), pa.array(tokenized.n_b), pa.array(groups, pa.int64()), pa.array(digests, pa.string()),
                     pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
                pairs.append(links)
                rows.append(owner + row)
                row, waiting = row + n, waiting + len(links)
                if waiting >= _RUN_LINKS:
                    yield from flush()
                    block, row, pairs, rows, waiting = block + 1, 0, [], [], 0
        yield from flush()

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, _SPILLED.format(kind=kind))


def _dealt(runs: DataFrame, salts: dict[int, int]) -> DataFrame:
    """Adds ``salt``: the runs of a radix that is too large to be merged at once are dealt out by block."""
    parts = F.element_at(F.create_map(*[F.lit(x) for pair in salts.items() for x in pair]), F.col("radix"))
    return runs.withColumn("salt", F.pmod(F.xxhash64("block"), parts).cast("int"))


def align_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", byte_model: str | None = None,
                    piece_model: str | None = None) -> Alignment:
    """Figures of every document's alignment, and the corpus-wide pairs.

    Null and empty texts, and those that a side does not give back byte for byte,
    have no tokens: zeros and an empty digest. Repeated rows and null keys count
    and come out one by one; further columns are dropped; an empty table gives none.
    """
    spark = docs.sparkSession
    paths = byte_model or public_tokenizers.path(BYTE_MODEL), piece_model or public_tokenizers.path(PIECE_MODEL)
    spilled = store(spill(docs, key, text, *paths), "spilled").df
    runs = spilled.where("radix IS NOT NULL").select("block", "radix", "run")
    sizes = runs.groupBy("radix").agg(F.sum(F.length("run")).alias("size")).collect()  # a row per radix
    salts = {r["radix"]: -(-r["size"] // _GROUP_BYTES) for r in sizes} or {0: 1}
    dealt, tasks = _dealt(runs, salts), sum(salts.values())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, own = None, []
        for batch in batches:
            for radix, salt, packed in zip(*(batch.column(c) for c in ("radix", "salt", "run"))):
                if (at := (radix.as_py(), salt.as_py())) != group and own:
                    yield _pairs_batch(*merge(own))
                    own = []
                group = at
                own.append(packed.as_py())
        if own:
            yield _pairs_batch(*merge(own))

    counted = dealt.repartition(tasks, "radix", "salt").sortWithinPartitions("radix", "salt").select("radix", "salt", "run").mapInArrow(
        count, "pair long, n long")
    totals = store(counted.groupBy("pair").agg(F.sum("n").alias("n")), "pairs").df

    def give_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, pairs, links, parts, best = None, None, None, [], None
        for batch in batches:
            for part in _constant(batch):
                at = part.column("radix")[0].as_py(), part.column("salt")[0].as_py()
                if at != group:
                    group, parts, pairs = at, [], None
                if part.column("run").null_count == part.num_rows:
                    parts.append((part.column("pair").to_numpy(), part.column("n").to_numpy()))
                    continue
                if pairs is None:
                    pairs, links = (np.concatenate(c) for c in zip(*parts))
                    best, parts = highest(pairs, links), []
                for block, packed in zip(part.column("block").to_pylist(), part.column("run")):
                    rows, n_best, total = shares(Run.unpack(packed.as_py()), pairs, links, best)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block] * len(rows), pa.int64()), pa.array(rows, pa.int32()), pa.array(n_best), pa.array(total)],
                        ["block", "row", "n_best", "count_sum"])

    radix = F.pmod(F.shiftright("pair", SIDE_BITS), F.lit(RADICES)).cast("int")
    width = F.element_at(F.create_map(*[F.lit(x) for pair in salts.items() for x in pair]), F.col("radix"))
    copies = totals.withColumn("radix", radix).withColumn("salt", F.explode(F.sequence(F.lit(0), width - 1))).select(
        "radix", "salt", "pair", "n", F.lit(None).cast("long").alias("block"), F.lit(None).cast("binary").alias("run"))
    second = copies.union(dealt.select("radix", "salt", F.lit(None).cast("long"), F.lit(None).cast("long"), "block", "run"))
    given = second.repartition(tasks, "radix", "salt").sortWithinPartitions("radix", "salt", F.col("pair").asc_nulls_last()).mapInArrow(
        give_back, "block long, row int, n_best long, count_sum long")
    sums = given.groupBy("block", "row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    own = spilled.where("radix IS NULL").drop("radix", "run").join(sums, ["block", "row"], "left")
    documents = own.select(
        F.col("key").alias(key), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        F.coalesce("n_best", F.lit(0).cast("long")).alias("n_best"), F.coalesce("count_sum", F.lit(0).cast("long")).alias("count_sum"),
        "groups_sha256")
    most = totals.groupBy(F.shiftright("pair", SIDE_BITS).alias("b")).agg(F.max("n").alias("most"))
    pairs = totals.withColumn("b", F.shiftright("pair", SIDE_BITS)).join(most, "b").select(
        F.col("pair").bitwiseAND(F.lit((1 << SIDE_BITS) - 1)).alias("a"), "b", F.col("n").alias("n_links"), (F.col("n") == F.col("most")).alias("best"))
    return Alignment(documents, pairs)


def _pairs_batch(pairs: np.ndarray, links: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(links)], ["pair", "n"])


def _constant(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with one radix, salt and kind of row each."""
    if batch.num_rows:
        keys = [np.asarray(batch.column(c).to_numpy(zero_copy_only=False), np.int64) for c in ("radix", "salt")]
        keys.append(batch.column("run").is_valid().to_numpy(zero_copy_only=False).astype(np.int64))
        change = np.any([np.diff(k) != 0 for k in keys], axis=0)
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            yield batch.slice(lo, hi - lo)
