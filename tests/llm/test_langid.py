import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest_llm import docs_of
from tidewatch.llm import langid
from tidewatch.llm.queries import QUERIES


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    docs = docs_of(spark, sf_dir)
    return langid.fit(docs.where(langid.teachable(F.col("doc_id"))))


def test_held_out_accuracy(spark, sf_dir):
    rows = QUERIES["op1_language_mixture"](spark, sf_dir).join(docs_of(spark, sf_dir).select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held) > 20
    assert all(0 <= r.score <= 1 for r in rows)


def test_two_languages_in_one_text(spark, sf_dir, model):
    text = {lang: " ".join(r.text for r in docs_of(spark, sf_dir).where(f"lang = '{lang}' AND length(text) > 400").limit(6).collect())[:2500]
            for lang in ("de", "fr")}
    share = langid.mixtures(*langid.word_likelihoods(model, [(text["de"] + "\n" + text["fr"]).encode()])[:2], 1)[0]
    found = dict(zip(model.languages, share))
    assert found["en"] == found["es"] == 0 and 0.25 < found["de"] < 0.75 and abs(share.sum() - 1) < 1e-6


def test_em_reaches_the_best_mixture():
    rng = np.random.default_rng(3)
    scores = np.minimum(rng.normal(0, 2, (400, 2)), 0).astype(np.float32)
    scores -= scores.max(axis=1, keepdims=True)
    share, total = langid._Mixture(scores, np.zeros(400, np.int64), 1).fit(np.ones((1, 2)))
    grid = np.linspace(0.001, 0.999, 999)
    values = [np.log(np.exp(scores) @ [p, 1 - p]).sum() for p in grid]
    assert abs(grid[int(np.argmax(values))] - share[0, 0]) < 0.02 and total[0] > max(values) - 0.05


def test_em_ends_at_the_maximum_for_similar_languages():
    """Several texts of unlike speed at once, against a grid; the bound holds from any proportions."""
    rng = np.random.default_rng(5)
    sizes, widths = (6000, 300, 3000), (0.3, 2.0, 0.6)
    scores = np.concatenate([np.outer(rng.normal(0.4 * w, w, n), [0.5, -0.5]) for n, w in zip(sizes, widths)])
    scores = (scores - scores.max(axis=1, keepdims=True)).astype(np.float32)
    of_word = np.repeat(np.arange(3), sizes)
    fit = langid._Mixture(scores, of_word, 3)
    share, total = fit.fit(np.ones((3, 2)))
    most = [max(np.log(np.exp(scores[of_word == i]) @ [p, 1 - p]).sum() for p in np.linspace(0, 1, 2001)) for i in range(3)]
    assert (total > np.array(most) - 0.1).all()
    for start in (share, np.full((3, 2), 0.5)):
        at = fit.sums(np.log(fit.spread(start) @ fit.ones))
        assert (fit.bound(start, at) >= np.array(most) - 1e-2).all()


def test_penalty_keeps_one_language():
    scores = np.zeros((50, 3), np.float32)
    scores[:, 1:] = -3
    assert langid.mixtures(scores, np.zeros(50, np.int64), 1).tolist() == [[1.0, 0.0, 0.0]]


def test_odd_rows(model, odd):
    rows = langid.identify(odd, model).collect()
    assert len(rows) == odd.count()
    und = [r for r in rows if r.lang_pred == "und"]
    assert len(und) == 4 and all(r.score == 0 and r.mixture == {} for r in und)
    assert langid.identify(odd.limit(0), model).count() == 0
    kept = langid.keep_identified(odd, model)
    assert kept.columns == odd.columns and 0 < kept.count() <= 6


def test_no_labels(odd):
    empty = langid.fit(odd)
    assert empty.languages == () and {r.lang_pred for r in langid.identify(odd, empty).collect()} == {"und"}


def test_long_text_is_read_whole(model):
    text = ("der die und nicht mit einer " * 20_000).encode()
    scores, of_word, _ = langid.word_likelihoods(model, [text])
    assert len(of_word) == 120_000 and not of_word.any() and len(text) > 2 * langid._BLOCK_BYTES


def plain_grams(text):
    """(word, order, bucket) of every n-gram of a text, one by one."""
    out, word, before, low = [], 0, [], text.lower() + " "
    kept = [(c if c.isalpha() else " ") for i, c in enumerate(low) if c.isalpha() or i and low[i - 1].isalpha()]
    for c in kept:
        before = [c, *before]
        state, open_ = 0, True
        for order in range(1, 5):
            back = before[order - 1] if order <= len(before) else " "
            if open_:
                state = (state * 0x9E3779B1 + ord(back)) % 2**32
            if order > 1:
                open_ &= back != " "
            if order > 1:
                out.append((word, order - 2, (state ^ state >> 15) * 0x85EBCA6B % 2**32 >> 16))
        word += c == " "
    return out


def plain_mixture(scores):
    """Proportions of the set with the best penalised likelihood, by many rounds from even proportions."""
    def fit(allowed):
        share = np.array(allowed, float) / sum(allowed)
        for _ in range(3000):
            joint = share * np.exp(scores)
            share = (joint / joint.sum(axis=1, keepdims=True)).mean(axis=0)
        return share, np.log((share * np.exp(scores)).sum(axis=1)).sum()

    languages = scores.shape[1]
    rank = np.argsort(np.argsort(-fit([1] * languages)[0], kind="stable"))
    single = np.eye(languages)[scores.sum(axis=0).argmax()]
    tried = [(scores.sum(axis=0).max(), single)]
    for size in range(2, languages + 1):
        share, total = fit(rank < size)
        tried.append((total - langid.PENALTY * 0.5 * np.log(max(len(scores), 2)) * (size - 1), share))
    return max(tried, key=lambda t: t[0])[1]


def test_table_and_sets_against_plain_code(spark, sf_dir, model):
    """The learned table from counted n-grams, then each document's mixture, in float64 and without shortcuts."""
    rows = docs_of(spark, sf_dir).collect()
    counts = {k: np.zeros((3, langid.BUCKETS)) for k in model.languages}
    grams = {r.doc_id: plain_grams(r.text) for r in rows}
    for r in rows:
        if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            for _, order, bucket in grams[r.doc_id]:
                counts[r.lang][order, bucket] += 1
    table = np.stack([np.log((c + langid.SMOOTHING) / (c + langid.SMOOTHING).sum(axis=1, keepdims=True)) for c in counts.values()], axis=2)
    assert np.allclose(table, model.table, atol=1e-4)
    found = {r.doc_id: r for r in langid.identify(docs_of(spark, sf_dir), model).collect()}
    for r in sorted(rows, key=lambda r: len(r.text))[:60]:
        own = grams[r.doc_id]
        if not own:
            assert found[r.doc_id].lang_pred == "und"
            continue
        raw = np.zeros((own[-1][0] + 1, len(model.languages)))
        size = np.zeros(len(raw))
        for word, order, bucket in own:
            raw[word] += table[order, bucket] / 3
            size[word] += 1 / 3
        foreign = (raw.max(axis=1) < -size * np.log(langid.BUCKETS)).mean()
        share = plain_mixture(np.maximum(raw - raw.max(axis=1, keepdims=True), -langid.WORD_BOUND))
        mine = np.array([found[r.doc_id].mixture.get(k, 0.0) for k in model.languages])
        assert np.allclose(mine, share, atol=0.03) and abs(found[r.doc_id].foreign - foreign) < 0.02
        assert found[r.doc_id].lang_pred == model.languages[share.argmax()]


def test_texts_in_no_learned_language_go(model, make_docs):
    strange = ["これは日本語の文章です。今日は天気がいいですね。", "Это предложение на русском языке и оно длинное"]
    own = [(10, "der die und nicht mit einer sch keit und die der das"), (11, "the and of that with the in thing er the and of")]
    kept = langid.keep_identified(make_docs([*enumerate(strange), *own]), model, 0.35)
    assert {r.doc_id for r in kept.collect()} == {10, 11}
    noise = (20, "xkcd qwrtp zzkvb mnbvc lkjhg qqzx wvtr pdfg")  # in letters of the languages; few rows taught this model
    found = {r.doc_id: r for r in langid.identify(make_docs([*enumerate(strange), *own, noise]), model).collect()}
    assert all(r.lang_pred in model.languages for r in found.values())
    assert found[0].foreign > 0.9 and found[1].foreign > 0.9 and found[20].foreign > 0 and found[10].foreign == found[11].foreign == 0


def test_the_sample_is_drawn_by_rows(spark, sf_dir, monkeypatch):
    """Copies of a text come one by one, so neither do all of them enter nor can a language of one text draw nothing."""
    monkeypatch.setattr(langid, "SAMPLE_PER_LANGUAGE", 40)
    rows = spark.range(4000).selectExpr("id AS doc_id", "if(id % 2 = 0, 'aa bb', concat('cc', id)) AS text", "if(id % 2 = 0, 'x', 'y') AS lang")
    model = langid.fit(rows)
    n = np.exp(-model.table[0].min(axis=0)) * langid.SMOOTHING - langid.SMOOTHING * langid.BUCKETS  # two-letter n-grams seen
    assert model.languages == ("x", "y") and 15 * 6 < n[0] < 80 * 6
    assert langid.fit(rows).table.tolist() == model.table.tolist()
    with pytest.raises(ValueError):
        langid.fit(rows.selectExpr("doc_id", "text", "text AS lang"))
