import hashlib

from pyspark.sql import functions as F

from conftest_llm import docs_of
from tidewatch.llm import syncmers


def tokens_hashes(spark, text):
    """Pair and window hashes by Spark's own hash, the choice by hand."""
    row = syncmers.with_tokens(spark.createDataFrame([(text,)], "t string"), "t").collect()[0]
    return row._tokens, row._pairs


def test_anchors_by_hand(spark):
    text = "The quick brown fox, the lazy dog; the quick brown fox jumped over 12 漢字 and the lazy dog again"
    tokens, pairs = tokens_hashes(spark, text)
    assert tokens[:6] == ["the", "quick", "brown", "fox", ",", "the"] and "漢" in tokens and "字" in tokens
    chosen = [i for i in range(len(tokens) - 4) if min(pairs[i], pairs[i + 3]) <= min(pairs[i + 1], pairs[i + 2])]
    df = spark.createDataFrame([(text,)], "t string")
    anchors = syncmers.with_anchors(df, "t").collect()[0].anchors
    assert [a.position for a in anchors] == chosen
    found = syncmers.with_fingerprint(df, "t", "f").collect()[0].f
    assert found == sorted({a.hash for a in anchors})[:syncmers.SKETCH]


def test_anchors_are_context_free(spark):
    passage = " ".join(f"word{i * 7919 % 1000}" for i in range(60))
    df = spark.createDataFrame([(passage,), ("some other beginning, here " + passage + " and an end",)], "t string")
    a, b = [{x.hash for x in r.anchors} for r in syncmers.with_anchors(df, "t").collect()]
    assert a and a <= b


def edited(texts):
    order = sorted(texts, key=lambda d: (d is not None, d), reverse=True)
    for i, d in enumerate(order):
        mine, following = texts[d], texts[order[(i + 1) % len(order)]]
        yield d, mine[:len(mine) - len(mine) // 2] + following[:len(mine) // 2]


def test_edits_and_likeness(spark, sf_dir):
    docs = {r.doc_id: r.text for r in docs_of(spark, sf_dir).collect()}
    rows = {r.doc_id: r for r in syncmers.compare_with_edits(docs_of(spark, sf_dir)).collect()}
    assert {d: r.edited_text for d, r in rows.items()} == dict(edited(docs)) and all(r.n_chars == len(docs[d]) for d, r in rows.items())
    order = sorted(docs, reverse=True)
    for i, d in enumerate(order):
        r, following = rows[d], rows[order[(i + 1) % len(order)]]
        for near, other in ((r.near_edited, r.edited_fingerprint), (r.near_next, following.fingerprint)):
            least = sorted({*r.fingerprint, *other})[:64]
            both = set(r.fingerprint) & set(other)
            assert abs(near - (sum(h in both for h in least) / len(least) if least else 1.0)) < 1e-12
    by_text = {}
    for d, r in rows.items():
        assert by_text.setdefault(docs[d], r.fingerprint) == r.fingerprint
    long = [r for r in rows.values() if r.n_chars > 1000]
    assert sum(r.near_edited > r.near_next for r in long) > 0.98 * len(long)


def test_nulls_ties_and_empty(spark, make_docs, odd):
    rows = [(3, "c c c"), (2, None), (2, "bbbb"), (1, ""), (None, "nullnull"), (3, "c c c")]
    found = syncmers.compare_with_edits(make_docs(rows, extra=True)).collect()
    got = sorted(((r.doc_id, r.n_chars, r.edited_text) for r in found), key=str)
    # after 3 comes the least text of 2, the empty one; after null comes 3
    assert got == sorted([(3, 5, "c c"), (3, 5, "c c"), (2, 0, ""), (2, 4, "bb"), (1, 0, ""), (None, 8, "nullc c ")], key=str)
    assert {r.doc_id: r.near_edited for r in found if r.n_chars == 0} == {2: 1.0, 1: 1.0}
    assert syncmers.compare_with_edits(odd).count() == odd.count()
    assert syncmers.compare_with_edits(odd.limit(0)).count() == 0


def test_one_document_follows_itself(make_docs):
    row = syncmers.compare_with_edits(make_docs([(1, "abcdef")])).collect()[0]
    assert row.edited_text == "abcabc" and row.near_next == 1.0


def test_successors_over_many_ranges(spark):
    keys = [((i * 7919) % 100_003, i) for i in range(3000)]
    df = spark.createDataFrame(keys, "k long, v long").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r.k: r.successor.k for r in syncmers.successors(df, "k").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    order = sorted((k for k, _ in keys), reverse=True)
    assert found == dict(zip(order, order[1:] + order[:1]))
