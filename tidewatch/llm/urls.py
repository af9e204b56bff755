"""URL filters: all glob rules run at once as one bit-parallel automaton.

A rule's glob is read against the canonical URL ``.host<boundary>path``. The
boundary is a symbol of its own, so a ``*`` in the host part never runs into
the path. Literals of all rules lie side by side in one multiword bit vector;
one Shift-And step per URL byte moves every rule forward.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.batches import blocks

BOUNDARY = 256
_SYMBOLS = 257
_BLOCK_BYTES = 8_000_000


@dataclass(frozen=True)
class Rule:
    """A verdict for a glob over the host and one over the path; ``*`` any run, ``?`` any byte.

    ``subdomains`` also lets every subdomain of the host match; ``prefix``
    lets the path go on after the glob.
    """

    verdict: str
    host: str
    path: str = ""
    subdomains: bool = True
    prefix: bool = True

    @property
    def name(self) -> str:
        return self.host + self.path

    def symbols(self) -> list[int | None]:
        """Byte values, BOUNDARY, -1 for ``?`` and None for ``*``."""
        def glob(text: str) -> list[int | None]:
            return [None if b == 42 else -1 if b == 63 else b for b in text.encode()]

        out: list[int | None] = [None, 46] if self.subdomains else [46]
        out += [*glob(self.host), BOUNDARY, *glob(self.path)]
        return [*out, None] if self.prefix else out


@dataclass(frozen=True)
class Automaton:
    """Masks of the packed rules, W words of 64 bits each."""

    accept: np.ndarray  # (symbols, W): positions that take the symbol
    stay: np.ndarray    # (W,): positions followed by ``*``
    first: np.ndarray   # (W,): first position of each rule
    floating: np.ndarray  # (W,): first positions of rules that start with ``*``
    final: np.ndarray   # (rules, 2): word and bit of each rule's last position


def compile_rules(rules: Sequence[Rule]) -> Automaton:
    """Pack the rules; a rule without any literal is refused."""
    at, spans = 0, []
    for rule in rules:
        symbols = rule.symbols()
        literals = [s for s in symbols if s is not None]
        if not literals:
            raise ValueError("a rule needs a literal")
        spans.append((at, symbols))
        at += len(literals)
    words = max(1, -(-at // 64))
    accept = np.zeros((_SYMBOLS, words), np.uint64)
    stay, first, floating = (np.zeros(words, np.uint64) for _ in range(3))
    final = np.zeros((len(rules), 2), np.int64)

    def put(row: np.ndarray, position: int) -> None:
        row[position // 64] |= np.uint64(1) << np.uint64(position % 64)

    for k, (start, symbols) in enumerate(spans):
        position = start - 1
        put(first, start)
        for symbol in symbols:
            if symbol is None:
                put(floating if position < start else stay, max(position, start))
                continue
            position += 1
            for s in range(256) if symbol == -1 else (symbol,):
                put(accept[s], position)
        final[k] = position // 64, position % 64
    return Automaton(accept, stay, first, floating, final)


def simulate(automaton: Automaton, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """(texts, rules) booleans: which rules match each of the concatenated symbol strings."""
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    sorted_lengths = lengths[order]
    state = np.zeros((len(lengths), len(automaton.stay)), np.uint64)
    one, top = np.uint64(1), np.uint64(63)
    for step in range(int(sorted_lengths[0]) if len(lengths) else 0):
        n = int(np.searchsorted(-sorted_lengths, -step, side="left"))
        old = state[:n]
        moved = old << one
        moved[:, 1:] |= old[:, :-1] >> top
        moved &= ~automaton.first  # no carry from the rule before
        moved |= automaton.first if step == 0 else automaton.floating
        moved &= automaton.accept[symbols[starts[:n] + step]]
        state[:n] = moved | (old & automaton.stay)
    word, bit = automaton.final.T
    hits = np.empty((len(lengths), len(word)), bool)
    hits[order] = (state[:, word] >> bit.astype(np.uint64)) & one
    return hits


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(pages: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url",
               otherwise: str = "allow", hostless: str = "block") -> DataFrame:
    """Verdict of the longest fitting rule per row: (key, host, path, rule, verdict).

    Length is that of host and path glob together; of equally long rules the
    one with the longer host, then a blocking one, then the first wins. A URL that
    no rule fits gets ``otherwise``, or ``hostless`` when it has no host (null
    URL, no ``://``). Each row gives one row, repeated and null keys included;
    other columns are dropped. The rules' masks are the only data sent to the tasks.
    """
    ranked = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.verdict != "block"))
    automaton = compile_rules(ranked) if ranked else None
    names = [r.name for r in ranked] + [None]
    verdicts = [r.verdict for r in ranked] + [otherwise]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = (batch.column(i).cast(pa.large_binary()).to_pylist() for i in (1, 2))
            best = np.full(len(hosts), len(ranked))
            if automaton is not None and hosts:
                best = _best(automaton, hosts, paths)
            verdict = [verdicts[b] if h or b < len(ranked) else hostless for b, h in zip(best, hosts)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([names[b] for b in best], pa.string()), pa.array(verdict, pa.string())],
                ["key", "host", "path", "rule", "verdict"])

    kind = pages.schema[key].dataType.simpleString()
    narrow = pages.select(F.col(key).alias("key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    out = narrow.mapInArrow(judge, f"key {kind}, host string, path string, rule string, verdict string")
    return out.withColumnRenamed("key", key)


def _best(automaton: Automaton, hosts: list[bytes], paths: list[bytes]) -> np.ndarray:
    """Index of the first matching rule, or the number of rules, in blocks of bounded size."""
    lengths = [len(h) + len(p) + 2 for h, p in zip(hosts, paths)]
    out = []
    for lo, hi in blocks(lengths, _BLOCK_BYTES):
        size = np.array(lengths[lo:hi])
        joined = b"".join(b".%b\0%b" % hp for hp in zip(hosts[lo:hi], paths[lo:hi]))
        symbols = np.frombuffer(joined, np.uint8).astype(np.int16)
        cut = np.cumsum(size) - size + 1 + np.array([len(h) for h in hosts[lo:hi]])
        symbols[cut] = BOUNDARY
        hits = simulate(automaton, symbols, size)
        out.append(np.where(hits.any(axis=1), hits.argmax(axis=1), hits.shape[1]))
    return np.concatenate(out)
