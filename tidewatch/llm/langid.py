"""Language identification as a mixture: which languages a text holds, and in what proportions.

Every word of a text has a log-likelihood under each learned language, from
character n-grams with counts smoothed and hashed into a table of fixed size.
Expectation-maximisation fits the proportions; the language set is the one
with the best penalised likelihood.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.batches import blocks, texts

UNDETERMINED = "und"
ORDERS = (2, 3, 4)
BUCKETS = 1 << 16  # as many as the hash has values
#: Bound of the training sample: expected number of labelled texts per language.
SAMPLE_PER_LANGUAGE = 1500
SMOOTHING = 0.3
#: More learned languages than this are taken for an error in the labels.
MOST_LANGUAGES = 256
#: Rounds between two looks at the log-likelihood, and the gain per look, absolute and per word, at which a fit ends.
ROUNDS = 8
GAIN, GAIN_PER_WORD = 1e-2, 1e-6
#: Cost of one more language, in units of half the log of the number of words.
PENALTY = 6.0
#: A word's advantage is bounded, so that one odd word does not make a language.
WORD_BOUND = 8.0
_BLOCK_BYTES = 200_000


def _code_points(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts, each followed by a blank, and the number of each text's."""
    lowered = [b.decode("utf-8", "replace").lower() for b in raw]
    sizes = np.array([len(s) + 1 for s in lowered], np.int64)
    joined = " ".join([*lowered, ""])
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), sizes


_LETTERS = np.array([chr(c).isalpha() for c in range(0x110000)])


def word_ngrams(raw: list[bytes]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashed n-grams of the letters of all texts.

    A word is a run of letters and the blank after it; its n-grams also reach
    back to the blank before it, and no further. Returns for each order the bucket
    of the n-gram that ends at each kept code point, the word of each kept code
    point, and the text of each word.
    """
    codes, sizes = _code_points(raw)
    letter = _LETTERS[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    points = np.where(letter, codes, np.uint32(32))[keep]
    blank = points == 32
    word = np.cumsum(blank) - blank
    of_word = np.repeat(np.arange(len(raw)), sizes)[keep][blank]
    out = []
    rolling = np.zeros(len(points), np.uint32)
    open_ = np.ones(len(points), bool)
    for order in range(1, max(ORDERS) + 1):
        before = np.concatenate([np.full(min(order - 1, len(points)), 32, np.uint32), points[:max(0, len(points) - order + 1)]])
        rolling = np.where(open_, rolling * np.uint32(0x9E3779B1) + before, rolling)
        if order > 1:
            open_ &= before != 32
        if order in ORDERS:
            mixed = (rolling ^ (rolling >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            out.append(mixed >> np.uint32(16))
    return out, word, of_word


@dataclass(frozen=True)
class LanguageModel:
    """Learned languages and a (orders, BUCKETS, languages) table of log-likelihoods."""

    languages: tuple[str, ...]
    table: np.ndarray


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learn a model from rows with text and language.

    Of each language about ``SAMPLE_PER_LANGUAGE`` whole texts are taken, by a
    hash of the row's key and text, or all where there are fewer; that bound makes the fit's
    cost independent of the table's size, and copies of a text are drawn one by one. More
    than ``MOST_LANGUAGES`` languages raise an error. Tasks count n-grams, Spark adds the
    counts; the driver gets a table of fixed size per language. Rows with a
    null text or language teach nothing; without any rows the model has no
    language and every text is ``und``.
    """
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(key).alias("key")).where(
        "text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = tuple(sorted(sizes))
    if not languages:
        return LanguageModel((), np.zeros((len(ORDERS), BUCKETS, 0), np.float32))
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, SAMPLE_PER_LANGUAGE / sizes[k]))])
    draw = F.pmod(F.xxhash64("text", "key"), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(draw < F.element_at(share, F.col("lang"))).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            raw, names = texts(batch.column(0)), batch.column(1).to_pylist()
            for name in set(names):
                own = [t for t, n in zip(raw, names) if n == name]
                total = sums.setdefault(name, np.zeros((len(ORDERS), BUCKETS), np.int64))
                parts = [p for t in own for p in _pieces(t)]
                for lo, hi in blocks([len(p) for p in parts], _BLOCK_BYTES):
                    for k, bucket in enumerate(word_ngrams(parts[lo:hi])[0]):
                        total[k] += np.bincount(bucket, minlength=BUCKETS)
        for name, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at)), pa.array(at.astype(np.int32)), pa.array(total.ravel()[at])],
                ["lang", "at", "n"])

    counted = sample.mapInArrow(count, "lang string, at int, n long").groupBy("lang", "at").agg(F.sum("n").alias("n"))
    counts = np.zeros((len(languages), len(ORDERS) * BUCKETS))
    found = counted.toArrow()
    index = {k: i for i, k in enumerate(languages)}
    counts[np.array([index[k] for k in found["lang"].to_pylist()], np.int64), found["at"].to_numpy()] = found["n"].to_numpy()
    counts = counts.reshape(len(languages), len(ORDERS), BUCKETS)
    smooth = counts + SMOOTHING
    table = np.log(smooth / smooth.sum(axis=2, keepdims=True))
    return LanguageModel(languages, np.ascontiguousarray(table.transpose(1, 2, 0), np.float32))


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in parts of bounded size, cut at white space where there is any."""
    at = 0
    while len(text) - at > _BLOCK_BYTES:
        cut = max(text.rfind(c, at, at + _BLOCK_BYTES) for c in (b" ", b"\n"))
        if cut <= at:
            cut = at + _BLOCK_BYTES
            while text[cut] & 0xC0 == 0x80 and cut > at + 1:
                cut -= 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def _score_words(model: LanguageModel, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    grams, word, of_word = word_ngrams(raw)
    if not len(of_word) or not model.languages:
        return np.zeros((len(of_word), len(model.languages)), np.float32), of_word, np.zeros(len(of_word), bool)
    points = model.table[0].take(grams[0], axis=0, mode="clip")
    for table, bucket in zip(model.table[1:], grams[1:]):
        points += table.take(bucket, axis=0, mode="clip")
    starts = np.flatnonzero(np.diff(word, prepend=-1))
    scores = np.add.reduceat(points, starts, axis=0) / np.float32(len(ORDERS))
    best = scores.max(axis=1, keepdims=True)
    foreign = best[:, 0] < np.diff(np.append(starts, len(word))) * np.float32(-np.log(BUCKETS))
    scores -= best
    return np.maximum(scores, np.float32(-WORD_BOUND)), of_word, foreign


def word_likelihoods(model: LanguageModel, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, languages) log-likelihoods relative to the best language of the word, each word's text, and whether it is foreign.

    A word is foreign if a background in which all n-grams are equally likely explains it better than every language.
    """
    parts, owner = [], []
    for i, text in enumerate(raw):
        for piece in _pieces(text):
            parts.append(piece)
            owner.append(i)
    scores, texts_of, foreign = [np.zeros((0, len(model.languages)), np.float32)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
    for lo, hi in blocks([len(p) for p in parts], _BLOCK_BYTES):
        s, t, f = _score_words(model, parts[lo:hi])
        scores.append(s)
        texts_of.append(np.array(owner[lo:hi], np.int64)[t])
        foreign.append(f)
    return np.concatenate(scores), np.concatenate(texts_of), np.concatenate(foreign)


class _Mixture:
    """Expectation-maximisation over many texts at once; each has at least one word."""

    def __init__(self, scores: np.ndarray, of_word: np.ndarray, n_texts: int) -> None:
        self.scores, self.like, self.of_word = scores, np.exp(scores), of_word
        self.count = np.bincount(of_word, minlength=n_texts).astype(np.float64)
        self.starts = np.flatnonzero(np.diff(of_word, prepend=-1))
        self.ones = np.ones(scores.shape[1], np.float32)

    def spread(self, share: np.ndarray) -> np.ndarray:
        """Each word's likelihood under each language, weighted by its text's proportions."""
        joint = share.astype(np.float32).take(self.of_word, axis=0, mode="clip")
        joint *= self.like
        return joint

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.starts, axis=0, dtype=np.float64)

    def only(self, which: np.ndarray) -> _Mixture:
        """The same for the texts at the sorted places ``which``."""
        rows = np.isin(self.of_word, which)
        return _Mixture(self.scores[rows], np.searchsorted(which, self.of_word[rows]), len(which))

    def fit(self, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Proportions over the allowed languages of each text, and their log-likelihood; rounds go on while it grows."""
        shares = allowed / allowed.sum(axis=1, keepdims=True)
        totals = np.full(len(shares), -np.inf)
        part, left = self, np.arange(len(shares))
        while True:
            share = shares[left]
            for _ in range(ROUNDS):
                joint = part.spread(share)
                joint /= (joint @ self.ones)[:, None]
                share = part.sums(joint) / part.count[:, None]
            total = part.sums(np.log(np.maximum(part.spread(share) @ self.ones, 1e-30)))
            grows = total - totals[left] > GAIN + GAIN_PER_WORD * part.count
            shares[left], totals[left] = share, total
            if not grows.any():
                return shares, totals
            if not grows.all():
                part, left = part.only(np.flatnonzero(grows)), left[grows]

    def bound(self, share: np.ndarray, total: np.ndarray) -> np.ndarray:
        """What the log-likelihood of no proportions exceeds, by concavity, however far the fit of ``share`` came."""
        mix = np.maximum(self.spread(share) @ self.ones, 1e-30)
        slope = self.sums(self.like / mix[:, None]).max(axis=1)
        return total + self.count * np.log(np.maximum(slope / self.count, 1.0))


def mixtures(scores: np.ndarray, of_word: np.ndarray, n_texts: int) -> np.ndarray:
    """(texts, languages): proportions of each text's chosen language set; all 0 for a text without words.

    A first fit over all languages ranks them per text. Then the sets of the
    best 1, 2, ... languages are fitted, and the set with the largest
    log-likelihood less the penalty is taken. Sets that even a bound of the
    likelihood of all proportions would not save are left out.
    """
    languages = scores.shape[1]
    chosen = np.zeros((n_texts, languages))
    filled, of_word = np.unique(of_word, return_inverse=True)
    if not languages or not len(filled):
        return chosen
    fit = _Mixture(scores, of_word, len(filled))
    alone = fit.sums(scores)
    single = alone.argmax(axis=1)
    picked = np.zeros((len(filled), languages))
    picked[np.arange(len(filled)), single] = 1.0
    if languages > 1:
        share, total = fit.fit(np.ones_like(picked))
        most = fit.bound(share, total)
        cost = PENALTY * 0.5 * np.log(np.maximum(fit.count, 2))
        best = alone.max(axis=1)
        doubt = np.flatnonzero(most - cost > best)
        for size in range(2, languages + 1):
            doubt = doubt[most[doubt] - cost[doubt] * (size - 1) > best[doubt]]
            if not len(doubt):
                break
            part = fit.only(doubt)
            rank = np.argsort(np.argsort(-share[doubt], axis=1, kind="stable"), axis=1, kind="stable")
            fitted, total = part.fit((rank < size).astype(np.float64))
            value = total - cost[doubt] * (size - 1)
            won = value > best[doubt]
            best[doubt[won]], picked[doubt[won]] = value[won], fitted[won]
    chosen[filled] = picked
    return chosen


def identified(model: LanguageModel, text: Column) -> Column:
    """Struct (lang, score, mixture, foreign) of each whole text; the model, of fixed size, goes to the tasks.

    ``lang`` is the language of the largest proportion (of equal ones the first
    in name order), ``score`` that proportion, ``mixture`` the proportions of
    the chosen set, ``foreign`` the share of words that no language explains better than
    the background. A null text and one without letters are ``und`` with scores
    0 and an empty mixture.
    """
    @F.arrow_udf("struct<lang: string, score: double, mixture: map<string, double>, foreign: double>")
    def run(column: pa.Array) -> pa.Array:
        shares, odd = [np.zeros((0, len(model.languages)))], [np.zeros(0)]
        sizes = [n or 0 for n in pc.binary_length(column).to_pylist()]
        for lo, hi in blocks(sizes, 4 * _BLOCK_BYTES // max(4, len(model.languages))):
            raw = [t or b"" for t in texts(column.slice(lo, hi - lo))]
            scores, of_word, foreign = word_likelihoods(model, raw)
            shares.append(mixtures(scores, of_word, hi - lo))
            odd.append(np.bincount(of_word, foreign, hi - lo) / np.maximum(np.bincount(of_word, minlength=hi - lo), 1))
        share = np.concatenate(shares)
        known = share.sum(axis=1) > 0
        top = share.argmax(axis=1) if len(model.languages) else np.zeros(len(column), np.int64)
        names = [model.languages[i] if k else UNDETERMINED for i, k in zip(top, known)]
        score = np.where(known, share.max(axis=1, initial=0.0), 0.0).clip(0.0, 1.0)
        sets = [[(model.languages[i], float(row[i])) for i in np.flatnonzero(row)] for row in share]
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(score), pa.array(sets, pa.map_(pa.string(), pa.float64())), pa.array(np.concatenate(odd))],
            ["lang", "score", "mixture", "foreign"])

    return run.asNondeterministic()(text)  # else a filter on it evaluates it a second time


def teachable(key: Column) -> Column:
    """The rows a model may learn from: the checksum of the key as text, modulo 4, is not 2."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 != 2, F.lit(False))


def identify(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score, mixture, foreign) of every row; repeated rows and null keys give a row each, further columns are dropped."""
    rows = docs.select(F.col(key).alias("key"), identified(model, F.col(text)).alias("found"))
    return rows.select(F.col("key").alias(key), F.col("found.lang").alias("lang_pred"), "found.score", "found.mixture", "found.foreign")


def keep_identified(docs: DataFrame, model: LanguageModel, least: float = 0.5, most_foreign: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs`` in one main language of proportion ``least`` or more, all their columns as they were.

    Rows of which more than ``most_foreign`` of the words are foreign go: they are in no learned language.
    """
    rows = docs.select(F.struct(*docs.columns).alias("row"), identified(model, F.col(text)).alias("found"))
    return rows.where((F.col("found.lang") != UNDETERMINED) & (F.col("found.score") >= least) & (F.col("found.foreign") <= most_foreign)).select("row.*")
