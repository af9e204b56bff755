"""Document fingerprints from closed syncmers, in built-in column expressions only.

A text is a sequence of tokens: words of an alphabetic script, single
ideographs and kana, single other signs. A window of five tokens is a closed syncmer if the
least hash of its inner pairs of tokens is that of the first or of the last
pair. Whether a window is chosen depends on its own tokens alone, so equal
passages yield equal anchors wherever they stand. A fingerprint is the
``SKETCH`` least hashes of a text's distinct syncmers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tidewatch.llm.tables import store

#: Tokens of a window. Its inner substrings are the four pairs of neighbours.
K = 5
SKETCH = 64
_TOKEN = r"[\u3040-\u30FF\u3400-\u9FFF\uF900-\uFAFF]|[\p{L}\p{N}]+|[^\s\p{Cntrl}]"


def with_tokens(df: DataFrame, text: str) -> DataFrame:
    """Adds ``_tokens``: lower-cased tokens of a whole text, and ``_pairs``: a hash per token and its successor."""
    words = F.regexp_extract_all(F.lower(F.col(text)), F.lit(_TOKEN), F.lit(0))
    return df.withColumn("_tokens", F.coalesce(words, F.array().cast("array<string>"))).withColumn(
        "_pairs", F.transform("_tokens", lambda t, i: F.xxhash64(t, F.get(F.col("_tokens"), i + 1))))


def _window_hash(i: Column) -> Column | None:
    """The hash of the window at ``i`` if it is a closed syncmer, else null; 31 bits."""
    pair = lambda k: F.get(F.col("_pairs"), i + k)
    chosen = (i <= F.size("_tokens") - K) & (F.least(pair(0), pair(3)) <= F.least(pair(1), pair(2)))
    return F.when(chosen, F.xxhash64(pair(0), pair(2), pair(3)).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"))


def with_anchors(df: DataFrame, text: str, name: str = "anchors") -> DataFrame:
    """Adds ``name``: array of (position, hash), the syncmers of the whole text in order; for positional matching."""
    found = F.transform("_pairs", lambda p, i: F.struct(i.alias("position"), _window_hash(i).alias("hash")))
    return with_tokens(df, text).withColumn(name, F.filter(found, lambda a: a["hash"].isNotNull())).drop("_tokens", "_pairs")


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds ``name``: ascending array of at most ``SKETCH`` hashes.

    A text that has tokens but no syncmer, as one of fewer than five tokens, has
    the hash of its whole token sequence; a text without tokens, as a null one,
    has an empty array.
    """
    hashes = F.array_compact(F.transform("_pairs", lambda p, i: _window_hash(i)))
    whole = F.array(F.xxhash64("_tokens").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"))
    hashed = with_tokens(df, text).withColumn("_hashes", hashes)
    full = F.when((F.size("_hashes") == 0) & (F.size("_tokens") > 0), whole).otherwise(F.array_distinct("_hashes"))
    return hashed.withColumn(name, F.slice(F.sort_array(full), 1, SKETCH)).drop("_tokens", "_pairs", "_hashes")


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common syncmers, 0 to 1, exact below ``SKETCH`` syncmers; two empty fingerprints are alike."""
    least = F.slice(F.sort_array(F.array_union(a, b)), 1, SKETCH)
    common = F.size(F.array_intersect(least, F.array_intersect(a, b)))
    return F.when(F.size(least) == 0, 1.0).otherwise(common / F.size(least))


def as_string(fingerprint: Column) -> Column:
    """Eight hexadecimal digits for each hash."""
    return F.array_join(F.transform(fingerprint, lambda h: F.lower(F.lpad(F.hex(h), 8, "0"))), "")


def successors(ids: DataFrame, key: str, descending: bool = True) -> DataFrame:
    """``ids`` (distinct keys, further columns) with ``successor``: a struct of the key that follows, after the last the first.

    Null comes last. Spark deals the keys out in ranges, which are stored with
    their number; inside a range a window finds the successor, and the last key
    of a range gets the first of the next range that has any, of which there is one per range.
    """
    order = F.col(key).desc_nulls_last() if descending else F.col(key).asc_nulls_last()
    ranges = store(ids.repartitionByRange(order).withColumn("_range", F.spark_partition_id()), "ranges").df
    within = Window.partitionBy("_range").orderBy(order)
    linked = ranges.withColumn("_next", F.lead(F.struct(key)).over(within)).withColumn("_row", F.row_number().over(within))
    across = Window.orderBy("_range")
    first = linked.where("_row = 1").select("_range", F.struct(key).alias("_first"))
    following = first.select(
        "_range", F.coalesce(F.lead("_first").over(across), F.first("_first").over(across)).alias("_following"))
    return linked.join(F.broadcast(following), "_range").withColumn(
        "successor", F.coalesce("_next", "_following")).drop("_range", "_next", "_row", "_following")


def compare_with_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of an edited text, and their likeness.

    (key, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited, near_next):
    the edited text is the first half, the longer one where they differ, and then as many code points as
    were cut off from the beginning of the next document by descending key. After the least
    key comes the greatest; a null key comes last. Rows with one key share
    their next document; among several texts of the next key the least counts. A
    null text is an empty one, further columns are dropped.

    Each text is shuffled once by its key, and of the next text only the part that
    is wanted goes back to its predecessor.
    """
    # an ordinary column as join key: a null-safe comparison would shuffle the texts once more
    name = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("")).alias("id")
    rows = docs.select(F.col(key).alias("key"), name(F.col(key)), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sizes = rows.select("key", F.char_length("text").cast("long").alias("n_chars"))
    wanted = sizes.groupBy("key").agg(F.max(F.expr("n_chars div 2")).alias("want"))
    asked = successors(wanted, "key").select(name(F.col("successor.key")), name(F.col("key")).alias("asker"), "want")
    dealt = with_fingerprint(rows, "text", "f").repartition("id")
    one = Window.partitionBy("id").orderBy("text", "key")
    least = dealt.withColumn("_n", F.row_number().over(one)).where("_n = 1")
    given = least.join(asked, "id").select(
        F.col("asker").alias("id"), F.expr("substring(text, 1, CAST(want AS INT))").alias("passage"), F.col("f").alias("next_f"))
    own = dealt.select("key", "id", "text", "f", F.char_length("text").cast("long").alias("n_chars"))
    cut = F.expr("concat(substring(text, 1, CAST(n_chars - n_chars div 2 AS INT)), substring(passage, 1, CAST(n_chars div 2 AS INT)))")
    edited = own.join(given, "id").select("key", "n_chars", "f", "next_f", cut.alias("edited_text"))
    return with_fingerprint(edited, "edited_text", "edited_f").select(
        F.col("key").alias(key), "n_chars", "edited_text", F.col("f").alias("fingerprint"),
        F.col("edited_f").alias("edited_fingerprint"), likeness(F.col("f"), F.col("edited_f")).alias("near_edited"),
        likeness(F.col("f"), F.col("next_f")).alias("near_next"))
