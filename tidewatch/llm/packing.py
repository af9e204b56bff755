"""Best-fit packing: planned over the histogram of lengths, then joined back to the pieces by rank.

The plan's size depends on the sequence length only, never on the number of
documents. Documents are cut into pieces, counted by length, and take the slots
planned for their length in the order of their rank within it.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping, Sequence
from functools import lru_cache
from typing import NamedTuple
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from tidewatch.llm.batches import blocks, byte_alphabet, texts
from tidewatch.llm.tables import store

CAPACITY = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
#: Pieces of one length that are ranked together, on average over the lengths' salted groups.
RANK_GROUP_ROWS = 20_000
CACHED_WORDS = 250_000
_CACHED_LENGTH = 64
_BLOCK_BYTES = 1_000_000

# The normaliser and pre-tokenizer of a lower-casing word model, and the pattern of its words.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": WORD_PATTERN}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
_WORD_END = "</w>"
#: Stands for a word's end among bytes; words of other than Latin letters, and those with control characters, take the library.
_MARK = "\x01"
_PLAIN = re.compile("[!-~\u00a1-\u012f\u0131-\u024f]+")
_WORD = regex.compile(WORD_PATTERN)


class WordModel:
    """The merges of a lower-casing word model, as byte-pair ranks with the word's end as one more byte.

    The end mark first joins the byte before it, which gives the model's own
    letters with a word's end; then the model's merges follow in their order.
    """

    def __init__(self, spec: dict) -> None:
        alphabet = byte_alphabet()

        def raw(token: str) -> bytes:
            plain = token.removesuffix(_WORD_END)
            return bytes(map(alphabet.__getitem__, plain)) + (_MARK.encode() if plain != token else b"")

        letters = {b: c for c, b in alphabet.items()}
        vocab, merges = spec["model"]["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        ranks = {bytes([b]): b for b in range(256)}
        ids = [vocab[letters[b]] for b in range(256)]
        tokens = [letters[b] + _WORD_END for b in range(256) if chr(b) != _MARK] + [a + b for a, b in merges]
        for token in tokens:
            if raw(token) not in ranks:
                ranks[raw(token)] = len(ids)
                ids.append(vocab[token])
        self.line = len(ids)  # not an id of the model
        ranks[b"\n\n"] = self.line
        self.ids = np.array([*ids, 0], "<u4")
        self.coder = tiktoken.Encoding("words", pat_str=f"[^{_MARK}\n]+{_MARK}|\n\n", mergeable_ranks=ranks, special_tokens={})

    def encode(self, words: Sequence[str]) -> list[bytes]:
        """Ids of words that ``_PLAIN`` takes whole, as little-endian 32-bit numbers."""
        text = "\n\n".join([*words, ""]).lower()
        found = np.array(self.coder.encode_ordinary(_WORD.sub(rf"\g<0>{_MARK}", text)), np.int64)
        at = np.flatnonzero(found == self.line)
        packed = self.ids[found].tobytes()
        return [packed[4 * (a + 1):4 * b] for a, b in zip([-1, *at.tolist()], at.tolist())]


class WordIds:
    """Token ids of texts as little-endian 32-bit numbers, from the ids of their words.

    A model that drops white space and never joins over it gives a text the ids of
    its words one after another. Such a model's words are remembered; when ``most`` are known they
    become the older generation, of which words that are met again return. With
    any other tokenizer file whole texts go to the library.
    """

    def __init__(self, path: str, most: int = CACHED_WORDS) -> None:
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        by_words = (spec["normalizer"], spec["pre_tokenizer"], model["type"], model["end_of_word_suffix"]) == (
            _NORMALIZER, _PRE_TOKENIZER, "BPE", _WORD_END) and not any(
            model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        self.model = WordModel(spec) if by_words else None
        self.special = tuple(t["content"] for t in spec["added_tokens"])
        self.most = most
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _by_library(self, text: bytes) -> bytes:
        return np.array(self.library.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes()

    def _fresh(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        plain, own = [], []
        for word in words:
            text = word.decode("utf-8", "replace")
            if _PLAIN.fullmatch(text) and not ("<|" in text and any(s in text for s in self.special)):
                plain.append(text)
                own.append(word)
            else:
                yield word, self._by_library(word)
        yield from zip(own, self.model.encode(plain))

    def encode(self, texts: Sequence[bytes | None]) -> list[bytes]:
        if not self.model:
            return [self._by_library(t or b"") for t in texts]
        split = [t.split() if t else [] for t in texts]
        known = self.known
        new = set().union(*split).difference(known)
        again = new.intersection(self.older)
        known.update((w, self.older[w]) for w in again)
        fresh = list(new - again)
        known.update(self._fresh(fresh))
        out = [b"".join(map(known.__getitem__, words)) for words in split]
        for word in fresh:
            if len(word) > _CACHED_LENGTH:
                del known[word]
        if len(known) > self.most:
            self.known, self.older = {}, known
        return out


@lru_cache
def word_ids(path: str, most: int) -> WordIds:
    """One tokenizer and cache per Python worker."""
    return WordIds(path, most)


def tokenize_pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                    tokenizer: str | None = None, with_ids: bool = True, cached_words: int = CACHED_WORDS) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]): every whole text's ids and an end id, cut where longer than ``capacity``.

    A null or empty text has the end id alone. Repeated rows and null keys give
    pieces of their own; further columns are dropped. Any file of the tokenizers library will do, though only one of the
    default's kind is read word by word. ``ids`` holds the piece's
    ids; leave it out where only the places are wanted. ``cached_words`` is what a
    Python worker remembers, at some 200 bytes a word, twice over; it changes time and memory alone.
    """
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    step = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(path, cached_words)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            row, number, at, size, check, bodies = [], [], [], [], [], []
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            coded = (ids for lo, hi in blocks(sizes, _BLOCK_BYTES) for ids in words.encode(texts(batch.column(1).slice(lo, hi - lo))))
            for i, ids in enumerate(coded):
                ids += end
                for lo in range(0, len(ids), step):
                    part = ids[lo:lo + step]
                    row.append(i)
                    number.append(lo // step)
                    at.append(lo // 4)
                    size.append(len(part) // 4)
                    check.append(crc32(part))
                    if with_ids:
                        bodies.append(np.frombuffer(part, "<u4").astype(np.int32))
            columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(number, pa.int32()),
                       pa.array(at, pa.int64()), pa.array(size, pa.int64()), pa.array(check, pa.int64())]
            names = ["key", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(bodies, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema)
    return rows.withColumnRenamed("key", key)


class Slots(NamedTuple):
    """Ranks ``first`` up to ``last`` (exclusive) of a length, ``each`` to a sequence from ``sequence`` on, at ``offset``."""

    length: int
    first: int
    last: int
    sequence: int
    each: int
    offset: int


def plan(histogram: Mapping[int, int], capacity: int = CAPACITY) -> list[Slots]:
    """Best-fit decreasing over counts: what placing the pieces one by one would do, without the pieces.

    Sequences with the same room are held as ranges. Pieces of a length go to
    the least room that holds one; best fit then keeps to that sequence while
    another one fits, so each range takes ``room // length`` per sequence. Only
    the last range of a length is split, and each visit to a range at least
    halves its room, so the plan has a few hundred thousand rows at most for a
    capacity of 4,096, and in practice some thousand.
    """
    rooms: dict[int, list[tuple[int, int]]] = {}
    ordered: list[int] = []
    slots: list[Slots] = []
    sequences = 0

    def put(room: int, first: int, count: int) -> None:
        if room and count:
            if room not in rooms:
                rooms[room] = []
                insort(ordered, room)
            rooms[room].append((first, count))

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} does not fit {capacity}")
        rank, left = 0, histogram[length]
        while left:
            at = bisect_left(ordered, length)
            if at < len(ordered):
                room = ordered[at]
                first, count = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room], ordered[at]
            else:
                room, first, count = capacity, sequences, -(-left // (capacity // length))
                sequences += count
            each = room // length
            full = min(count, left // each)
            if full:
                slots.append(Slots(length, rank, rank + full * each, first, each, capacity - room))
                put(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if full < count and left:
                slots.append(Slots(length, rank, rank + left, first + full, left, capacity - room))
                put(room - left * length, first + full, 1)
                full, left = full + 1, 0
            put(room, first + full, count - full)
    return slots


def ranked(pieces: DataFrame, key: str, groups: int) -> DataFrame:
    """Adds ``rank``: gapless numbers from 0 among the pieces of a length, counted in ``groups`` salted parts."""
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64(key, "piece", "ids_crc32"), F.lit(groups)).cast("int"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = salted.groupBy("length", "salt").count().select(
        "length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "salt").orderBy(key, "piece", "ids_crc32")
    return salted.withColumn("place", F.row_number().over(within) - 1).join(base, ["length", "salt"]).withColumn(
        "rank", F.col("base") + F.col("place")).drop("salt", "base", "place")


def assign(pieces: DataFrame, key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; offsets of a sequence leave no gap.

    ``pieces`` (key, piece, length, ids_crc32, ...) is read twice, so it should be
    a stored table. The driver gets the histogram, at most ``capacity`` rows; the
    plan is broadcast, its size bounded by the capacity as well.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    slots = spark.createDataFrame(
        [tuple(map(int, s)) for s in plan(histogram, capacity)],
        "length long, first long, last long, sequence long, each long, base long")
    groups = max(1, -(-sum(histogram.values()) // RANK_GROUP_ROWS))
    rows = ranked(pieces, key, groups)
    placed = rows.join(F.broadcast(slots), "length").where("rank >= first AND rank < last")
    return placed.withColumn("sequence_id", F.expr("sequence + (rank - first) div each")).withColumn(
        "offset", F.expr("base + length * ((rank - first) % each)")).select(
        *[c for c in pieces.columns], "sequence_id", "offset")


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         tokenizer: str | None = None, with_ids: bool = False, cached_words: int = CACHED_WORDS) -> DataFrame:
    """Pieces of every document with their place in a sequence of at most ``capacity`` ids.

    See :func:`tokenize_pieces` for nulls, repeated rows and further columns. An
    empty table gives no piece.
    """
    pieces = tokenize_pieces(docs, key, text, capacity, tokenizer, with_ids, cached_words)
    return assign(store(pieces, "pieces").df, key, capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids, starts): the packed sequences, from pieces with ``ids``; each has at most the capacity's ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.flatten(F.col("p.ids")).alias("ids"), F.col("p.offset").alias("starts"))
