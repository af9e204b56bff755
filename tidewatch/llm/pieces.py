"""SentencePiece encoding by suffix-array matching, and decoding.

For a batch of text, all suffixes are sorted to the depth of the longest piece; a
binary search for every piece of the vocabulary gives the range of suffixes
that start with it, that is, all its occurrences. The occurrences are the edges
of a lattice; sorted by position they are relaxed from left to right.

For a byte-pair model, relaxing rests on two facts: the encoding of a text's
beginning is the encoding of a shorter beginning and one more piece; and a
sequence of pieces is an encoding if, and only if, every two neighbours are. So
each position has one incoming edge that is right, namely the one whose piece fits
the piece that ends where it starts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from sentencepiece import SentencePieceProcessor

from tidewatch.llm.batches import blocks

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
_BATCH_CHARS = 400_000
_BLOCK_BYTES = 2_000_000
_CACHED_SEGMENTS = 250_000
_CACHED_LENGTH = 64
_VERDICTS = 1 << 20
#: No piece holds a space or a line feed inside, so texts fall apart there.
_SEGMENT = re.compile(r"\n| +[^ \n]*|[^ \n]+")


class Vocabulary:
    """Pieces of a byte-pair model with identity normalisation, and which pairs of them stay apart."""

    def __init__(self, pieces: Sequence[str], ranks: Sequence[int], byte_ids: Sequence[int], unknown: int) -> None:
        """``ranks`` order the merges, least first; pieces of rank -1 are never matched (control, byte, unused)."""
        self.byte_ids, self.unknown = byte_ids, unknown
        self.index = {p: i for i, p in enumerate(pieces) if ranks[i] >= 0}
        self.none = len(pieces)  # stands for a character without a piece
        self.length = np.array([len(p) if p in self.index else 0 for p in pieces] + [1], np.int64)
        self.depth = int(self.length.max(initial=1))
        self.ids = np.array(list(self.index.values()), np.int64)
        self.codes = np.zeros((len(self.ids), self.depth), np.uint32)  # a piece per row, 0 after its end
        for row, piece in zip(self.codes, self.index):
            row[:len(piece)] = list(map(ord, piece))
        self.merge_rank = np.full(len(pieces) + 1, -1, np.int64)
        pairs = {}
        for piece, i in self.index.items():
            if len(piece) > 1:
                self.merge_rank[i] = ranks[i]
                for cut in range(1, len(piece)):
                    a, b = self.index.get(piece[:cut]), self.index.get(piece[cut:])
                    if a is not None and b is not None:
                        pairs[a, b] = i
        keys = np.array([a * (self.none + 1) + b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], self.merge_rank[np.array(list(pairs.values()), np.int64)[order]]
        self.left, self.right = np.zeros(self.none + 1, np.int64), np.zeros(self.none + 1, np.int64)
        self.whole = np.zeros(self.none + 1, bool)  # pieces that are the encoding of their own text
        self.whole[self.none] = True
        for piece, i in self.index.items():
            parts = self._last_merge(piece, pairs)
            self.whole[i] = parts is not None
            if parts:
                self.left[i], self.right[i] = parts
        self._seen = np.full(_VERDICTS, -1, np.int64)  # pairs by hash, the last one met of each
        self._apart = np.zeros(_VERDICTS, bool)

    def _last_merge(self, piece: str, pairs: dict[tuple[int, int], int]) -> tuple[int, ...] | None:
        """The two parts from which merging makes the piece; () for a character; None if it comes out otherwise."""
        symbols = [self.index.get(c) for c in piece]
        if None in symbols:
            return None
        last: tuple[int, ...] = ()
        while len(symbols) > 1:
            merges = [(self.merge_rank[m], k, m) for k, ab in enumerate(zip(symbols, symbols[1:]))
                      if (m := pairs.get(ab)) is not None]
            if not merges:
                return None
            _, k, merged = min(merges)
            last = (symbols[k], symbols[k + 1])
            symbols[k:k + 2] = [merged]
        return last if symbols == [self.index[piece]] else None

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the pieces stay apart when their texts are encoded together.

        Merging is run backwards at the boundary. Before each undone merge, a
        merge across the boundary would have come first if its rank is less, or
        equal and further left.
        """
        good = np.ones(len(a), bool)
        live = np.flatnonzero((a != self.none) & (b != self.none))
        a, b = a[live], b[live]
        limit = np.full(len(live), np.iinfo(np.int64).max)
        while len(live):
            at = np.searchsorted(self.pair_keys, a * (self.none + 1) + b).clip(max=len(self.pair_keys) - 1)
            met = (self.pair_keys[at] == a * (self.none + 1) + b) & (self.pair_ranks[at] < limit)
            good[live[met]] = False
            go = ~met & ((self.merge_rank[a] >= 0) | (self.merge_rank[b] >= 0))
            live, a, b = live[go], a[go], b[go]
            back = self.merge_rank[a] > self.merge_rank[b]
            limit = np.where(back, self.merge_rank[a], self.merge_rank[b] + 1)
            a, b = np.where(back, self.right[a], a), np.where(back, b, self.left[b])
        return good

    def fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The same as :meth:`compatible`; verdicts on pairs met before are remembered in a table of fixed size."""
        pairs = a * (self.none + 1) + b
        at = ((pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)
        good = self._apart[at]
        missed = np.flatnonzero(self._seen[at] != pairs)
        if len(missed):
            new, back = np.unique(pairs[missed], return_inverse=True)
            verdicts = self.compatible(new // (self.none + 1), new % (self.none + 1))
            good[missed] = verdicts[back]
            self._seen[at[missed]] = pairs[missed]
            self._apart[at[missed]] = good[missed]
        return good


def load(path: str) -> tuple[Vocabulary, SentencePieceProcessor]:
    """The vocabulary of a byte-pair model file; other normalisation than a space in front is refused."""
    model = SentencePieceProcessor(model_file=path)
    if model.normalize("a  Bé ﬁ") != f"{SPACE}a{SPACE * 2}Bé{SPACE}ﬁ":
        raise ValueError("only identity normalisation with a leading space is supported")
    n = model.vocab_size()
    pieces = [model.id_to_piece(i) for i in range(n)]
    usable = [not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(n)]
    if any(SPACE in p.lstrip(SPACE) or "\n" in p for p, u in zip(pieces, usable) if u):
        raise ValueError("pieces that go over a space or a line feed are not supported")
    rank = {i: r for r, i in enumerate(sorted((i for i in range(n) if usable[i]), key=lambda i: -model.get_score(i)))}
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    return Vocabulary(pieces, [rank.get(i, -1) for i in range(n)], byte_ids, model.unk_id()), model


def occurrences(codes: np.ndarray, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, row of the piece) of every occurrence of every piece in a text of code points.

    Rows of ``pieces`` are padded with 0, which also separates parts of the text and is in no piece.
    """
    depth = pieces.shape[1]
    alphabet, ranks = np.unique(np.append(codes, 0), return_inverse=True)
    ranks = ranks[:-1].astype(np.uint64)
    bits = max(1, int(len(alphabet) - 1).bit_length())
    per_word = 63 // bits
    n_words = -(-depth // per_word)
    padded = np.concatenate([ranks, np.zeros(n_words * per_word, np.uint64)])
    words = []
    for w in range(n_words):
        word = np.zeros(len(codes), np.uint64)
        for k in range(per_word):
            at = w * per_word + k
            word = (word << np.uint64(bits)) | (padded[at:at + len(codes)] if at < depth else np.uint64(0))
        words.append(word)
    suffixes = np.lexsort(words[::-1])
    words = [w[suffixes] for w in words]

    within = np.searchsorted(alphabet, pieces).clip(max=len(alphabet) - 1)
    present = np.flatnonzero((alphabet[within] == pieces).all(axis=1))  # the others hold a character that the text has not
    if not len(present):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = (pieces[present] != 0).sum(axis=1)
    table = np.zeros((len(present), n_words * per_word), np.uint64)
    table[:, :depth] = within[present]
    lo, hi = np.zeros(len(present), np.int64), np.full(len(present), len(codes))
    for w in range(n_words):
        low, high = np.zeros(len(present), np.uint64), np.zeros(len(present), np.uint64)
        for k in range(per_word):
            at = w * per_word + k
            inside = at < size
            low = (low << np.uint64(bits)) | table[:, at]
            high = (high << np.uint64(bits)) | np.where(inside, table[:, at], np.uint64((1 << bits) - 1))
        lo, hi = _bound(words[w], lo, hi, low, False), _bound(words[w], lo, hi, high, True)
    count = np.maximum(hi - lo, 0)
    ends = np.cumsum(count)
    slots = np.arange(ends[-1]) - np.repeat(ends - count, count) + np.repeat(lo, count)
    return suffixes[slots], np.repeat(present, count)


def _bound(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, key: np.ndarray, after: bool) -> np.ndarray:
    """Binary search of each key inside its own range; after equal values if ``after``."""
    lo, hi = lo.copy(), np.maximum(hi, lo)
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        middle = (lo + hi) // 2
        found = values[np.minimum(middle, len(values) - 1)]
        right = open_ & ((found <= key) if after else (found < key))
        lo = np.where(right, middle + 1, lo)
        hi = np.where(open_ & ~right, middle, hi)


def encode_segments(vocabulary: Vocabulary, segments: Sequence[str]) -> list[bytes]:
    """Ids of each segment, as little-endian 32-bit numbers; the segments are indexed and matched together."""
    sizes = np.array([len(s) for s in segments], np.int64)
    codes = np.frombuffer("\0".join([*segments, ""]).replace(" ", SPACE).encode("utf-32-le", "surrogatepass"), np.uint32)
    begin = np.cumsum(sizes + 1) - sizes - 1
    owner = np.repeat(np.arange(len(segments)), sizes + 1)
    inside = np.arange(len(codes)) - begin[owner]
    separator = inside == sizes[owner]
    codes = np.where(separator, 0, np.where(codes == 0, 0x110000, codes))  # a NUL of a text is no separator
    start, row = occurrences(codes, vocabulary.codes)
    piece = vocabulary.ids[row]
    single = np.zeros(len(codes), bool)
    single[start[vocabulary.length[piece] == 1]] = True
    lone = np.flatnonzero(~single & ~separator)
    start, piece = np.concatenate([start, lone]), np.concatenate([piece, np.full(len(lone), vocabulary.none)])
    usable = vocabulary.whole[piece]
    start, piece = start[usable], piece[usable]
    # one number per edge: how far into its segment it starts, where, and its length
    far, wide = int(len(codes)).bit_length(), int(vocabulary.depth).bit_length()
    edges = (((inside[start] << far) | start) << wide) | vocabulary.length[piece]
    order = np.argsort(edges)
    start, piece = start[order], piece[order]

    last = np.full(len(codes) + 1, -1, np.int64)
    steps = np.flatnonzero(np.diff(inside[start], prepend=-1)).tolist() + [len(start)]
    for lo, hi in zip(steps, steps[1:]):  # all edges that start equally far into their segments
        s, p = start[lo:hi], piece[lo:hi]
        if inside[s[0]]:
            before = last[s]
            reached = before >= 0
            s, p, before = s[reached], p[reached], before[reached]
            fits = vocabulary.fits(before, p)
            s, p = s[fits], p[fits]
        last[s + vocabulary.length[p]] = p

    at, live = begin + sizes, np.flatnonzero(sizes > 0)
    where, what = [], []
    at = at[live]
    floor = begin[live]
    while len(at):
        p = last[at]
        if (p < 0).any():
            raise ValueError("a position cannot be reached: the vocabulary is not closed under merging")
        at = at - vocabulary.length[p]
        where.append(at)
        what.append(p)
        more = at > floor
        at, floor = at[more], floor[more]
    position, ids = np.concatenate(where or [np.zeros(0, np.int64)]), np.concatenate(what or [np.zeros(0, np.int64)])
    order = np.argsort(position)
    position, ids = position[order], ids[order]
    if (ids == vocabulary.none).any():  # characters without a piece fall back to their bytes
        own = [np.array([vocabulary.byte_ids[b] for b in chr(c if c < 0x110000 else 0).encode("utf-8", "surrogatepass")])
               for c in codes[position[ids == vocabulary.none]].tolist()]
        count = np.ones(len(ids), np.int64)
        count[ids == vocabulary.none] = [len(b) for b in own]
        position, wide = np.repeat(position, count), np.repeat(ids, count)
        wide[wide == vocabulary.none] = np.concatenate(own)
        ids = wide
    packed = ids.astype("<u4").tobytes()
    bounds = (4 * np.searchsorted(position, np.append(begin, len(codes)))).tolist()
    return [packed[a:b] for a, b in zip(bounds, bounds[1:])]


class Encoder:
    """Encodes whole texts; segments met before are remembered within a bound.

    When ``_CACHED_SEGMENTS`` are known they become the older generation, of which those met again return.
    """

    def __init__(self, path: str) -> None:
        self.vocabulary = load(path)[0]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        if len(self.known) > _CACHED_SEGMENTS:
            self.known, self.older = {}, self.known
        split = [_SEGMENT.findall(" " + t.replace(SPACE, " ")) if t else [] for t in texts]
        known, older = self.known, self.older
        new = set().union(*split).difference(known)
        again = new.intersection(older)
        known.update((s, older[s]) for s in again)
        fresh = list(new - again)
        for lo, hi in blocks([len(s) + 1 for s in fresh], _BATCH_CHARS):
            known.update(zip(fresh[lo:hi], encode_segments(self.vocabulary, fresh[lo:hi])))
        out = [b"".join(map(known.__getitem__, segments)) for segments in split]
        for s in fresh:
            if len(s) > _CACHED_LENGTH:
                del known[s]
        return out


class Decoder:
    """Puts texts together from ids."""

    def __init__(self, path: str) -> None:
        model = SentencePieceProcessor(model_file=path)
        byte_of = {model.piece_to_id(f"<0x{b:02X}>"): bytes([b]) for b in range(256)}
        plain = [b"" if model.is_control(i) else model.id_to_piece(i).replace(SPACE, " ").encode() for i in range(model.vocab_size())]
        self.bytes_of = [" ⁇ ".encode() if model.is_unknown(i) else byte_of.get(i, p) for i, p in enumerate(plain)]

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids)).removeprefix(b" ")


@lru_cache
def encoder(path: str) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(path)


@lru_cache
def decoder(path: str) -> Decoder:
    """One decoder per Python worker."""
    return Decoder(path)


def encode_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str | None = None) -> DataFrame:
    """(key, ids, ids_crc32, text_sha256): every whole text's ids, as the model's own library gives them.

    A null text is an empty one and has no ids. Repeated rows and null keys give
    a row each; further columns are dropped.
    """
    path = model or public_tokenizers.path(MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for batch in batches:
            for lo, hi in blocks(pc.binary_length(batch.column(1)).to_pylist(), _BLOCK_BYTES):
                packed = tool.encode(batch.column(1).slice(lo, hi - lo).to_pylist())
                ends = np.cumsum([0] + [len(p) // 4 for p in packed])
                ids = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), "<u4").astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), ids, pa.array([crc32(p) for p in packed], pa.int64()),
                     batch.column(2).slice(lo, hi - lo)], ["key", "ids", "ids_crc32", "text_sha256"])

    kind = docs.schema[key].dataType.simpleString()
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), body.alias("text"), F.sha2(body, 256).alias("text_sha256"))
    return rows.mapInArrow(run, f"key {kind}, ids array<int>, ids_crc32 long, text_sha256 string").withColumnRenamed("key", key)


def decode_documents(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded`` in place of ``ids``: the text the ids stand for; null ids are null.

    A text comes back as it was, but for the model's own sign for a space, which becomes one.
    """
    path = model or public_tokenizers.path(MODEL)

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        tool = decoder(path)
        rows = (None if not row.is_valid else tool.decode(row.values.to_pylist()).decode("utf-8", "replace") for row in column)
        return pa.array(rows, pa.string())  # one row's ids at a time as Python numbers

    return encoded.withColumn("decoded", run("ids")).drop("ids")
