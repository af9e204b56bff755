"""SimHash near-duplicates: fingerprints meet at the anchor points of a covering code.

The anchors are the words of a direct sum of perfect codes, so that every
fingerprint has exactly one nearest anchor within the covering radius. If two
fingerprints differ in at most ``threshold`` bits, then the nearest anchor of
the one lies within covering radius plus threshold of the other. Each
fingerprint is at home at its nearest anchor, is replicated to every anchor
within that distance, block by block, and homes meet replicas per anchor.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tidewatch.llm.batches import each_text
from tidewatch.llm.components import components
from tidewatch.llm.tables import store

WIDTH = 3
THRESHOLD = 2
SEED = 42
#: Homes of one anchor that are compared one by one; beyond it they are linked over the points between them.
CROWD = 500
FINGERPRINTS_PER_TASK = 20_000
_BLOCK = 1 << 15

#: Perfect codes over consecutive bits from the lowest: (length, generator polynomial, covering radius).
# The binary Golay code and a Hamming code. Three bits stay out of the anchors.
CODES = ((23, 0b110001110101, 3), (23, 0b110001110101, 3), (15, 0b10011, 1))


def fingerprint(text: bytes | None, width: int = WIDTH) -> int:
    """Unsigned 64-bit SimHash of the shingles of ``width`` words, repeats included; 0 without a word."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts = np.zeros(len(words), np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words))[:-1] + 1, out=starts[1:])
    n = max(1, len(words) - width + 1)
    ends = np.append(starts[width:], len(joined) + 1)[:n] - 1 if len(words) > width else np.array([len(joined)])
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for lo in range(0, n, _BLOCK):
        spans = zip(starts[lo:min(n, lo + _BLOCK)].tolist(), ends[lo:lo + _BLOCK].tolist())
        hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n, bitorder="little").tobytes(), "little")


def fingerprinted(text: Column) -> Column:
    """The fingerprint of each whole text, as a signed 64-bit number."""
    @F.arrow_udf("long")
    def run(column: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t) for t in each_text(column)], np.uint64).view(np.int64))

    return run(text)


def as_hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _remainder(words: np.ndarray, length: int, generator: int) -> np.ndarray:
    degree = generator.bit_length() - 1
    left = words.copy()
    for bit in range(length - 1, degree - 1, -1):
        left ^= np.where(left >> bit & 1, generator << (bit - degree), 0)
    return left


@lru_cache
def error_table(length: int, generator: int, radius: int, threshold: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per extra distance t: the errors of weight radius + t (at t = 0: up to radius) by syndrome, padded, and their number.

    A word minus an error of its syndrome is a code word, that is, an anchor.
    """
    syndromes = 1 << (generator.bit_length() - 1)
    levels: list[list[list[int]]] = [[[] for _ in range(syndromes)] for _ in range(threshold + 1)]
    weighted = [np.zeros(1, np.int64)]
    for _ in range(radius + threshold):
        last = weighted[-1]
        grown = [last[last < (1 << bit)] | (1 << bit) for bit in range(length)]
        weighted.append(np.concatenate(grown))
    for weight, errors in enumerate(weighted):
        for syndrome, error in zip(_remainder(errors, length, generator).tolist(), errors.tolist()):
            levels[max(0, weight - radius)][syndrome].append(error)
    out = []
    for lists in levels:
        count = np.array([len(x) for x in lists])
        table = np.zeros((syndromes, max(1, count.max())), np.int64)
        for row, errors in zip(table, lists):
            row[:len(errors)] = errors
        out.append((table, count))
    return out


def reachable(values: np.ndarray, extra: int, tables: list[list[tuple[np.ndarray, np.ndarray]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index, anchor) of every anchor within covering radius plus ``extra`` of each fingerprint, in parts."""
    pieces, shift = [], 0
    for length, generator, _ in CODES:
        word = ((values >> np.uint64(shift)) & np.uint64((1 << length) - 1)).astype(np.int64)
        pieces.append((word, _remainder(word, length, generator), shift))
        shift += length
    for levels in product(range(extra + 1), repeat=len(CODES)):
        if sum(levels) > extra:
            continue
        anchors, valid = np.zeros((len(values), 1), np.int64), np.ones((len(values), 1), bool)
        for (word, syndrome, at), table, t in zip(pieces, tables, levels):
            errors, count = table[t]
            code = (word[:, None] ^ errors[syndrome]) << at
            fits = np.arange(errors.shape[1]) < count[syndrome][:, None]
            anchors = (anchors[:, :, None] | code[:, None, :]).reshape(len(values), -1)
            valid = (valid[:, :, None] & fits[:, None, :]).reshape(len(values), -1)
        index, place = np.nonzero(valid)
        yield index, anchors[index, place]


def anchored(fingerprints: DataFrame, extra: int) -> DataFrame:
    """(anchor, f): a row for every anchor within covering radius plus ``extra``; with 0, each fingerprint's home alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [error_table(*code, extra) for code in CODES]
        for batch in batches:
            every = batch.column(0).to_numpy(zero_copy_only=False)
            for lo in range(0, len(every), 2048):
                own = every[lo:lo + 2048]
                for index, anchor in reachable(own.view(np.uint64), extra, tables):
                    yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(own[index])], ["anchor", "f"])

    return fingerprints.select("f").mapInArrow(run, "anchor long, f long")


def links(fingerprints: DataFrame) -> DataFrame:
    """(a, b) edges that connect exactly those distinct fingerprints that chains of links connect.

    At an anchor with up to ``CROWD`` homes, every pair of home and replica in
    reach is an edge, once. The members of a more crowded anchor are linked without
    forming pairs: two fingerprints differ in at most two bits if, and only if,
    both lie within one bit of a common point, so each such point ties its
    members to the least of them.
    """
    # an explicit number of partitions, since one fingerprint becomes some 150 rows after this shuffle; as Spark's
    # estimates know nothing of these rows, it would broadcast them, so the join's kind is named
    parts = max(1, -(-fingerprints.count() // FINGERPRINTS_PER_TASK))
    fingerprints = fingerprints.select("f").repartition(parts, "f")
    homes = anchored(fingerprints, 0).select("anchor", F.col("f").alias("h"))
    sizes = homes.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    crowded = sizes.where(F.col("n") > CROWD).select("anchor", F.lit(None).cast("long").alias("h"))
    targets = homes.join(sizes.where(F.col("n") <= CROWD), "anchor").select("anchor", "h").union(crowded)
    met = targets.join(anchored(fingerprints, THRESHOLD).hint("merge"), "anchor").where(
        f"h IS NULL OR (h < f AND bit_count(h ^ f) <= {THRESHOLD})").select("h", "f")
    met = store(met, "links").df
    flips = F.array(F.lit(0).cast("long"), *[F.lit(np.int64(np.uint64(1 << i).view(np.int64)).item()).cast("long") for i in range(64)])
    points = met.where("h IS NULL").select("f").distinct().select("f", F.explode(flips).alias("flip")).select(
        "f", F.col("f").bitwiseXOR(F.col("flip")).alias("point"))
    # a point has 65 members at most, so no join is needed, whose size after the explode Spark would take for that before
    least = F.min("f").over(Window.partitionBy("point"))
    stars = points.select("f", least.alias("b")).where("f > b").select(F.col("f").alias("a"), "b").distinct()
    return met.where("h IS NOT NULL").select(F.col("f").alias("a"), F.col("h").alias("b")).union(stars)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, f, root, component_id): each row's fingerprint, the least fingerprint and the least key that links reach from it.

    All rows of one fingerprint belong together, texts without a word (null,
    empty, white space) included, whose fingerprint is 0. Only distinct
    fingerprints are replicated and linked, so exact copies cost nothing more,
    however many there are. Null keys never become a component id unless the
    component has no other key. Repeated rows give a row each; further columns
    are dropped.
    """
    rows = store(docs.select(F.col(key).alias("key"), fingerprinted(F.col(text)).alias("f")), "fingerprints").df
    nodes = rows.groupBy("f").agg(F.min("key").alias("first"))
    roots = components(links(nodes))
    rooted = nodes.join(roots, nodes.f == roots.node, "left").select(
        "f", "first", F.coalesce("root", "f").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("f", "root", "component_id")
    return rows.join(named, "f").select(F.col("key").alias(key), "f", "root", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, with all its columns: that of the least key, of equal keys any one.

    A component without a non-null key keeps one of its rows as well.
    """
    found = near_duplicates(docs, key, text)
    best = found.groupBy("root").agg(F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), "f")).alias("best"))
    keepers = best.select(F.col("best.key").alias("k"), F.col("best.f").alias("g"))
    repeated = found.groupBy(F.col(key).alias("r")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("r", F.lit(True).alias("many"))
    marked = keepers.join(repeated, F.col("k").eqNullSafe(F.col("r")), "left").select("k", "many").distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("key"), F.col(text).alias("text"))
    held = rows.join(marked, F.col("key").eqNullSafe(F.col("k")))
    alone = held.where("many IS NULL").select("row")
    # only where rows share a key does the fingerprint say which of them is meant
    several = held.where("many").select("row", "key", fingerprinted(F.col("text")).alias("f")).join(
        keepers, F.col("key").eqNullSafe(F.col("k")) & (F.col("f") == F.col("g")), "left_semi")
    one = Window.partitionBy("key", "f").orderBy(F.lit(0))
    single = several.withColumn("n", F.row_number().over(one)).where("n = 1").select("row")
    return alone.union(single).select("row.*")
