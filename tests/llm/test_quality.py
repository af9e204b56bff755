from collections import defaultdict

from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from conftest_llm import docs_of
from tidewatch.llm import quality


def brute(words):
    places = defaultdict(list)
    for i in range(len(words) - 4):
        places[tuple(words[i:i + 5])].append(i)
    return len({i + k for at in places.values() if len(at) > 1 for i in at for k in range(5)})


@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60))
def test_repeated_windows(words):
    assert quality.repeat_words(words) == brute(words)


def test_measures():
    text = "Ab #x éé\n\nAb #x éé\n  \nlast|".encode()
    assert dict(zip(quality.MEASURES, quality.measure(text))) == {
        "n_words": 7, "word_chars": 17, "n_symbols": 3, "n_dup_lines": 1, "n_repeat_words": 0, "n_lines": 3, "n_upper": 2, "n_letters": 10}


def test_bits_policies_and_ablations(spark, sf_dir):
    rows = quality.ledger(docs_of(spark, sf_dir)).cache()
    for i, (name, condition) in enumerate(quality.RULES):
        assert rows.where(f"((failed & {1 << i}) <> 0) <> ({condition})").count() == 0, name
    bits = [r.failed for r in rows.select("failed").collect()]
    for r in quality.ablations(rows).collect():
        mask, bit = quality.bits_of(quality.POLICIES[r.policy]), quality.bits_of((r.rule,))
        assert (r.n_docs, r.n_failed, r.n_rejected, r.n_only) == (
            len(bits), sum(b & bit != 0 for b in bits), sum(b & mask != 0 for b in bits), sum(b & mask == bit for b in bits))


def test_rule_that_alone_rejects(spark):
    rows = spark.range(128).withColumnRenamed("id", "failed")
    names = {n: quality.bits_of((n,)) for n, _ in quality.RULES}
    for policy, rules in quality.POLICIES.items():
        mask = quality.bits_of(rules)
        for r in rows.select("failed", quality.only_rule(F.col("failed"), policy).alias("only")).collect():
            assert r.only == next((n for n in rules if r.failed & mask == names[n]), None)


def test_clean_labelled_documents_stay(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1")
    rows = quality.ledger(docs_of(spark, sf_dir)).join(labels, "doc_id")
    only_method = rows.where(quality.kept(F.col("failed"), "base") & ~quality.kept(F.col("failed")))
    assert rows.count() > 50 and only_method.count() <= 0.01 * rows.count()


def test_odd_rows(odd):
    rows = quality.ledger(odd).collect()
    assert len(rows) == odd.count() and all(r.n_words == 0 and r.failed & 1 for r in rows if r.doc_id in (1, 2, 3))
    kept = quality.keep_documents(odd)
    assert kept.columns == odd.columns and kept.count() == 0
    assert quality.ledger(odd.limit(0)).count() == 0 == quality.ablations(quality.ledger(odd.limit(0))).count()
