"""Quality rules: every rule is evaluated once into a ledger of measurements and failure bits.

Policies are versioned bit masks over the ledger. Verdicts and ablations read
the stored bits and never the texts again.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.batches import each_text

WINDOW = 5
SYMBOLS = b"#*$%&|<>"
_CONTINUATION = bytes(range(0x80, 0xC0))  # UTF-8 bytes that do not start a code point

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters")

#: Rule name and failure condition over the measurements; the position is the bit.
RULES: tuple[tuple[str, str], ...] = (
    ("too_few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("symbols", "10 * n_symbols > 3 * n_words"),
    ("repeated_lines", "n_lines >= 4 AND 10 * n_dup_lines > 4 * n_lines"),
    ("shouting", "n_letters >= 50 AND 10 * n_upper > 5 * n_letters"),
)
BASE_RULES = ("too_few_words", "repeated_windows")

#: Policies by version: the rules that reject.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE_RULES,
    "v1": (*BASE_RULES, "short_words", "long_words", "symbols"),
    "v2": tuple(name for name, _ in RULES),
}
DEFAULT_POLICY = "v2"


def bits_of(rules: tuple[str, ...]) -> int:
    """Mask of the named rules."""
    at = {name: i for i, (name, _) in enumerate(RULES)}
    return sum(1 << at[name] for name in set(rules))


def repeat_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words covered by windows of ``width`` words that occur at least twice, first ones included.

    Windows get exact integer names: names of w words pair up to names of 2 w,
    overlapping at the end where ``width`` is no power of two.
    """
    n = len(words) - width + 1
    if n < 2:
        return 0
    index: dict[bytes, int] = {}
    names = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    if len(index) == len(words):
        return 0
    span = 1
    while span < width:
        step = min(span, width - span)
        pairs = names[:len(names) - step] * (len(words) + 1) + names[step:]
        _, names, sizes = np.unique(pairs, return_inverse=True, return_counts=True)
        if len(sizes) == len(names):
            return 0
        span += step
    marks = np.zeros(len(words) + 1, np.int64)
    hot = np.flatnonzero(sizes[names] > 1)
    np.add.at(marks, hot, 1)
    np.add.at(marks, hot + width, -1)
    return int((np.cumsum(marks) > 0).sum())


_NOT_SYMBOL = bytes(sorted(set(range(256)) - set(SYMBOLS)))
_UPPER = bytes(range(65, 91))
_NOT_LETTER = bytes(sorted(set(range(256)) - set(_UPPER) - set(range(97, 123))))


def measure(text: bytes | None) -> tuple[int, ...]:
    """The MEASURES of one whole text; a null text is measured as an empty one."""
    text = text or b""
    words = text.split()
    code_points = len(b"".join(words).translate(None, _CONTINUATION))
    lines = [line for line in text.split(b"\n") if line.split(None, 1)]
    letters = text.translate(None, _NOT_LETTER)
    return (len(words), code_points, len(text.translate(None, _NOT_SYMBOL)), len(lines) - len(set(lines)),
            repeat_words(words), len(lines), len(letters) - len(letters.translate(None, _UPPER)), len(letters))


def measured(text: Column) -> Column:
    """Struct of the MEASURES of each text."""
    kind = ", ".join(f"{m}: long" for m in MEASURES)

    @F.arrow_udf(f"struct<{kind}>")
    def run(column: pa.Array) -> pa.Array:
        rows = np.array([measure(t) for t in each_text(column)], np.int64).reshape(-1, len(MEASURES))
        return pa.StructArray.from_arrays([pa.array(c) for c in rows.T], list(MEASURES))

    return run.asNondeterministic()(text)  # else a filter on it evaluates it a second time


def failure_bits() -> Column:
    """Bit i is set where rule i fails; reads the MEASURES columns."""
    return F.expr(" + ".join(f"IF({condition}, {1 << i}L, 0L)" for i, (_, condition) in enumerate(RULES)))


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, MEASURES, failed): measurements and failure bits of every row, from its whole text.

    A null or empty text has no words and so fails ``too_few_words``. Repeated
    rows and null keys give a row each; further columns are dropped; an empty
    table gives an empty ledger.
    """
    rows = docs.select(F.col(key).alias("key"), measured(F.col(text)).alias("m")).select("key", "m.*")
    return rows.withColumn("failed", failure_bits()).withColumnRenamed("key", key)


def kept(failed: Column, policy: str = DEFAULT_POLICY) -> Column:
    """Whether a row passes a policy, from its stored bits."""
    return failed.bitwiseAND(F.lit(bits_of(POLICIES[policy]))) == 0


def keep_documents(docs: DataFrame, policy: str = DEFAULT_POLICY, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass the policy, all their columns as they were."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), measured(F.col(text)).alias("m"))
    return rows.select("row", "m.*").where(kept(failure_bits(), policy)).select("row.*")


def only_rule(failed: Column, policy: str = DEFAULT_POLICY) -> Column:
    """The rule that alone makes a policy reject a row, from its stored bits; null where none or several do."""
    hits = failed.bitwiseAND(F.lit(bits_of(POLICIES[policy])))
    return F.coalesce(*[F.when(hits == bits_of((rule,)), rule) for rule in POLICIES[policy]])


def ablations(stored: DataFrame, policies: Mapping[str, tuple[str, ...]] = POLICIES) -> DataFrame:
    """Per policy and rule: (policy, rule, n_docs, n_failed, n_rejected, n_only): what the rule adds.

    ``n_only`` rows are rejected by this rule alone and would return without
    it. The ledger is first reduced to one row per combination of bits, of which
    there are at most 2 to the number of rules.
    """
    combined = stored.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    wanted = [(name, rule, bits_of(rules), 1 << i)
              for name, rules in policies.items() for i, (rule, _) in enumerate(RULES) if rule in rules]
    cases = F.explode(F.array(*[
        F.struct(F.lit(a).alias("policy"), F.lit(b).alias("rule"), F.lit(c).cast("long").alias("mask"),
                 F.lit(d).cast("long").alias("bit")) for a, b, c, d in wanted]))
    hits = F.col("failed").bitwiseAND(F.col("mask"))
    count = lambda when: F.sum(F.when(when, F.col("n")).otherwise(0))
    return combined.select("failed", "n", cases.alias("c")).select("failed", "n", "c.*").groupBy("policy", "rule").agg(
        F.sum("n").alias("n_docs"), count(F.col("failed").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        count(hits != 0).alias("n_rejected"), count(hits == F.col("bit")).alias("n_only"))
