import corpus_pipeline
from pyspark.sql import functions as F

from conftest_llm import docs_of
from tidewatch.llm import langid, quality, simhash
from test_packing import check, pieces_of
from test_simhash import broadcast_rows, brute_components, brute_fingerprint
from tokenizers import Tokenizer
import public_tokenizers
from tidewatch.llm.packing import TOKENIZER


def test_stages_one_by_one(spark, sf_dir):
    """Each stage's rows from its own input, by plain code."""
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "language", "near_duplicates", "pack"]
    docs = docs_of(spark, sf_dir).cache()
    by_name = dict(corpus_pipeline.STAGES)

    first = by_name["quality_rules"](spark, docs, sf_dir).cache()
    fails = {"too_few_words": lambda m: m["n_words"] < 10, "repeated_windows": lambda m: 100 * m["n_repeat_words"] > 20 * m["n_words"],
             "short_words": lambda m: m["word_chars"] < 2 * m["n_words"], "long_words": lambda m: m["word_chars"] > 20 * m["n_words"],
             "symbols": lambda m: 10 * m["n_symbols"] > 3 * m["n_words"],
             "repeated_lines": lambda m: m["n_lines"] >= 4 and 10 * m["n_dup_lines"] > 4 * m["n_lines"],
             "shouting": lambda m: m["n_letters"] >= 50 and 10 * m["n_upper"] > 5 * m["n_letters"]}
    good = {r for r in docs.collect() if not any(f(dict(zip(quality.MEASURES, quality.measure(r.text.encode())))) for f in fails.values())}
    assert set(first.collect()) == good and 0 < first.count() < docs.count()

    second = by_name["language"](spark, first, sf_dir).cache()
    model = langid.fit(first.where(langid.teachable(F.col("doc_id"))))
    stay = {r.doc_id for r in langid.identify(first, model).collect() if r.lang_pred != "und" and r.score >= corpus_pipeline.LEAST_SHARE}
    assert {r.doc_id for r in second.collect()} == stay and second.columns == docs.columns

    third = by_name["near_duplicates"](spark, second, sf_dir).cache()
    rows = second.collect()
    roots = brute_components([brute_fingerprint(r.text) for r in rows])
    least = {}
    for r in rows:
        root = roots[brute_fingerprint(r.text)]
        least[root] = min(r.doc_id, least.get(root, r.doc_id))
    assert sorted(r.doc_id for r in third.collect()) == sorted(least.values()) and third.columns == docs.columns
    assert third.count() < second.count()

    tokenizer = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    expected = pieces_of(tokenizer, [(r.doc_id, r.text) for r in third.collect()], 4096)
    assert check(by_name["pack"](spark, third, sf_dir).collect(), expected, 4096) <= 1.02 * sum(p[3] for p in expected) / 4096 + 1

    whole = corpus_pipeline.run(spark, sf_dir)
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in whole.collect()} == expected


def test_near_duplicates_broadcast_no_more_rows_than_documents(spark, make_docs, monkeypatch, sf_dir):
    """What a plan broadcasts goes through the driver's memory; replicas of fingerprints are many more than documents."""
    texts = [f"text {i} has {i * 7} words and {i * i} letters, some {i * 31} of them its own" for i in range(300)]
    stored, store = [], simhash.store
    monkeypatch.setattr(simhash, "store", lambda df, purpose: stored.append(df) or store(df, purpose))
    kept = corpus_pipeline.near_duplicates(spark, make_docs([*enumerate(texts), (300, texts[7]), (301, texts[9].upper())]), sf_dir)
    assert len(stored) == 2
    for df in (*stored, kept):
        assert max(broadcast_rows(df), default=0) <= 302
    assert 0 < kept.count() <= 300


def test_clean_documents_stay(spark, sf_dir):
    docs = docs_of(spark, sf_dir)
    kept = corpus_pipeline.language(spark, corpus_pipeline.quality_rules(spark, docs, sf_dir), sf_dir)
    clean = docs.join(spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1"), "doc_id").where(
        F.size(F.split("text", r"\s+")) >= 12)
    assert clean.join(kept, "doc_id", "left_anti").count() <= 0.02 * clean.count()


def test_odd_tables(spark, odd, sf_dir):
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == odd.columns
    empty = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0
