"""Operators against brute force on small, deliberately skewed data."""

import itertools
import random
import re
import statistics

import numpy as np
import pytest
from pyspark.sql import Window as W, functions as F

from tidewatch.operators import filters as FL, ingest as I, ordering as O, quality as Q, vectors as VEC
from tidewatch.operators.pairs import pair_rows, top_pairs
from tidewatch.operators.windows import blocked_window, budget_prefix
from tidewatch.suite import REGISTRY


@pytest.fixture(scope="module")
def values():
    rng = random.Random(7)
    rows = [("hot", 5.0)] * 400 + [("hot", rng.gauss(0, 1e6)) for _ in range(300)]
    rows += [("one", 3.5), ("same", 2.0), ("same", 2.0), ("two", -1.0), ("two", 9.0)]
    rows += [("far", float(i)) for i in range(150)] + [("far", 1e12), ("null", None)]
    rng.shuffle(rows)
    return rows


def grouped(rows):
    out = {}
    for k, v in rows:
        if v is not None:
            out.setdefault(k, []).append(v)
    return out


@pytest.mark.parametrize("bucket_rows", [1, 40, 50_000])
def test_inclusive_quantiles(spark, values, bucket_rows):
    df = spark.createDataFrame(values, "k string, v double")
    probs = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r.k: r for r in O.exact_quantiles(df, ["k"], "v", probs, bucket_rows=bucket_rows).collect()}
    want = grouped(values)
    assert set(got) == set(want)
    for k, vs in want.items():
        for name, p in probs.items():
            assert got[k][name] == pytest.approx(np.percentile(vs, p * 100), rel=1e-12, abs=1e-9)


def test_exclusive_p95(spark, values):
    df = spark.createDataFrame(values, "k string, v double")
    got = {r.k: r.p for r in O.exact_quantiles(df, ["k"], "v", {"p": 0.95}, method="exclusive").collect()}
    for k, vs in grouped(values).items():
        if len(vs) >= 20:
            assert got[k] == pytest.approx(statistics.quantiles(vs, n=100)[94])
    assert Q.p95_within(df, ["k"], "v", {"far": 1.0}).filter("k = 'far'").first().within is False


@pytest.mark.parametrize("bucket_rows", [1, 50_000])
@pytest.mark.parametrize("descending", [True, False])
def test_rank_with_ties(spark, values, bucket_rows, descending):
    vs = [v for _, v in values if v is not None]
    df = spark.createDataFrame([(v,) for v in vs], "v double")
    got = {r.v: r.rank for r in O.rank_map(df, "v", "rank", descending, bucket_rows).collect()}
    for v in set(vs):
        assert got[v] == 1 + sum(x > v if descending else x < v for x in vs)


def test_an_outlier_does_not_empty_the_buckets(spark):
    rng = np.random.default_rng(4)
    drawn = [float(x) for x in rng.lognormal(0, 2, 20_000)] + [1e9]
    counts = O.value_counts(spark.createDataFrame([(v,) for v in drawn], "v double"), [], "v")
    sizes = [r["count"] for r in O._bucketed(counts, [], "v", 200).groupBy(*O._PLACE).count().collect()]
    assert 80 <= len(sizes) <= 400 and max(sizes) <= 2 * 200


def test_odd_numbers_have_places_in_order(spark):
    """Infinities, not-a-number, values far apart; sorted as Spark sorts them, through cells of one value each."""
    values = [float("-inf"), -1e300, -2.0, -0.0, 1e-300, 3.0, 3.5, 1e9, 1e9 + 1, 1e300, float("inf"), float("nan")] * 2
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = O.with_rank(df, "v", "rank", descending=False).join(df.withColumn("want", F.rank().over(W.orderBy("v"))).select("i", "want"), "i")
    assert got.where("rank <> want").count() == 0
    small = {(r.i, r["rank"]) for r in df.join(O.rank_map(df, "v", "rank", False, 1), "v").collect() if r.v == r.v}
    assert small == {(r.i, r.want) for r in got.collect() if r.v == r.v}


@pytest.mark.parametrize("bucket_rows", [1, 7, 50_000])
def test_row_number_by_two_columns_with_nulls(spark, bucket_rows):
    rng = random.Random(3)
    rows = [(k, rng.choice([None, 1, 2, 3]), i) for i in range(300) for k in ("a", "b")]
    df = spark.createDataFrame(rows, "k string, x int, y int")
    got = {(r.k, r.y): r.rn for r in O.with_row_number(df, ["k"], ["x", "y"], "rn", bucket_rows).collect()}
    for k in "ab":
        order = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        assert [got[k, y] for _, _, y in order] == list(range(1, 301))


def test_row_number_and_sequence(spark):
    ids = random.Random(1).sample(range(10_000), 500)
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    stored = spark.createDataFrame([(41,)], "sequence bigint")
    got = {r.id: r.sequence for r in I.append_with_sequence(stored, df, "id").collect()}
    assert [got[i] for i in sorted(ids)] == list(range(42, 542))
    assert {r.id: r.sequence for r in I.append_with_sequence(stored.limit(0), df, "id").collect()}[min(ids)] == 1


@pytest.mark.parametrize("block", [3, 7, 512])
def test_pairs_of_a_hot_group(spark, block):
    edges = [("hot", f"i{n:03d}") for n in range(40)] + [("a", "i001"), ("a", "i002"), ("b", "i009"), ("c", "x"), ("c", "i001")]
    df = spark.createDataFrame(edges, "g string, i string")
    got = sorted((r.g, r.item_a, r.item_b) for r in pair_rows(df, "g", "i", [], block).collect())
    groups = {}
    for g, i in edges:
        groups.setdefault(g, []).append(i)
    want = sorted((g, *p) for g, items in groups.items() for p in itertools.combinations(sorted(items), 2))
    assert got == want


@pytest.mark.parametrize("limit,seeds", [(1, 3), (5, 4), (1000, 8)])
def test_top_pairs_with_a_hot_group_of_loners(spark, limit, seeds):
    rng = random.Random(5)
    groups = {f"g{n}": rng.sample([f"i{k:02d}" for k in range(30)], 5) for n in range(60)}
    groups["hot"] = [f"loner{n:03d}" for n in range(200)] + ["i01", "i02", "i03"]
    edges = [(g, i) for g, items in groups.items() for i in items]
    df = spark.createDataFrame(edges, "g string, i string")
    seen = []

    def stats(part):
        seen.append(part)
        return pair_rows(part, "g", "i", []).groupBy("item_a", "item_b").agg(F.count(F.lit(1)).alias("n"))

    out = top_pairs(df, "i", {"n": F.count(F.lit(1))}, stats, limit, {"n": 2}, seeds)
    got = [(r.n, r.item_a, r.item_b) for r in out.orderBy(F.desc("n"), "item_a", "item_b").limit(limit).collect()]
    count = {}
    for items in groups.values():
        for p in itertools.combinations(sorted(items), 2):
            count[p] = count.get(p, 0) + 1
    want = sorted(((n, *p) for p, n in count.items() if n >= 2), key=lambda r: (-r[0], r[1:]))[:limit]
    assert got == want
    # No loner takes part in any pair.
    assert seen[-1].filter("i LIKE 'loner%'").count() == 0


@pytest.mark.parametrize("block_rows", [30, 64, 1000])
def test_blocked_window_equals_plain_window(spark, block_rows):
    rows = [("long", i, float((i * 37) % 101)) for i in range(250)] + [("short", i, float(i)) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, step bigint, v double")
    build = {"s": lambda w: F.sum("v").over(w.rowsBetween(-23, 0)), "l": lambda w: F.lag("v", 20).over(w)}
    got = sorted(map(tuple, blocked_window(df, ["k"], "step", 23, build, block_rows).collect()))
    w = W.partitionBy("k").orderBy("step")
    want = sorted(map(tuple, df.select("*", *[b(w).alias(n) for n, b in build.items()]).collect()))
    assert got == want


def test_budget_prefix_stops_at_first_overflow(spark):
    df = spark.createDataFrame([("q", 1, 5), ("q", 2, 7), ("q", 3, 1), ("r", 1, 99)], "q string, rank int, n int")
    assert [(r.q, r.rank) for r in budget_prefix(df, ["q"], "rank", F.col("n"), 10).collect()] == [("q", 1)]


def vectors(spark, n, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(6)] + [(n + 10, [0.0] * 8)]
    return spark.createDataFrame(rows, "id bigint, embedding array<double>"), rows


def test_recall_of_every_query_at_depth_100(spark, sf_dir):
    """Means of labels and every 50th vector, a hundred neighbours and a verdict each."""
    vec = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    want = vec.select("label").distinct().count() + vec.filter("vec_id % 50 = 0").count()
    rows = REGISTRY["vector_lsh_recall"].build(spark, sf_dir).collect()
    assert len(rows) == want and all(r.wanted == 100 and r.enough and r.recall_enough for r in rows)
    assert REGISTRY["vector_topk_lsh"].build(spark, sf_dir).count() == 100 * want


@pytest.mark.parametrize("rows_per_block,queries_per_slice", [(4096, 512), (17, 1)])
def test_vector_topk_over_cells(spark, rows_per_block, queries_per_slice):
    df, rows = vectors(spark, 200, 3)
    queries, asked = vectors(spark, 4, 4)
    queries = queries.withColumnRenamed("id", "q")
    got = VEC.vector_topk(df, queries, item="id", query="q", k=5, rows_per_block=rows_per_block, queries_per_slice=queries_per_slice)
    hits = {}
    for r in got.orderBy("q", "rank").collect():
        hits.setdefault(r.q, []).append(r.id)
    for q, v in asked:
        def similarity(x):
            n = np.linalg.norm(v) * np.linalg.norm(x)
            return round(float(np.dot(v, x) / n), 9) if n else 0.0
        want = sorted(rows, key=lambda r: (-similarity(r[1]), r[0]))[:5]
        assert hits[q] == [r[0] for r in want]


def test_vector_topk_ties_at_the_digits_asked_for(spark):
    """Ranks follow the similarity as it is shown, rounded once."""
    df = spark.createDataFrame([(1, [1.0, 0.02000001]), (2, [1.0, 0.02]), (3, [0.0, 1.0])], "id bigint, embedding array<double>")
    asked = spark.createDataFrame([(9, [1.0, 0.0])], "q bigint, embedding array<double>")
    ids = lambda digits: [r.id for r in VEC.vector_topk(df, asked, item="id", query="q", k=2, digits=digits).orderBy("rank").collect()]
    assert ids(6) == [1, 2] and ids(10) == [2, 1]
    shown = VEC._rounded(np.array([0.2493044997, 0.2493045, -0.2493045, 0.0009765625, np.nan]), 6)
    assert shown[:4].tolist() == [0.249304, 0.249305, -0.249305, 0.000977] and np.isnan(shown[4])
    assert VEC._rounded(np.array([0.0009765625]), 9).tolist() == [0.000976563]


def test_coded_vectors(spark, sf_dir):
    """Recall against the exact search, exact similarities, and rows that no index takes."""
    vec = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    odd = spark.createDataFrame([(-1, [0.0] * 64), (-2, None), (-3, [1.0] * 63), (-4, [None] * 64)], vec.schema)
    queries = vec.filter("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    index = VEC.vector_index(vec.union(odd), item="vec_id", dimensions=64)
    assert index.rows == vec.count() == index.codes.count()
    exact = VEC.vector_topk(vec, queries, item="vec_id", query="query_id", k=10)
    found = VEC.vector_topk_coded(index, queries, item="vec_id", query="query_id", k=10, rows_per_block=100, queries_per_slice=3)
    assert VEC.recall_at_k(exact, found, item="vec_id", query="query_id").agg(F.avg("recall")).first()[0] >= 0.9
    true = {(r.query_id, r.vec_id): r.similarity for r in VEC.vector_topk(vec, queries, item="vec_id", query="query_id", k=500).collect()}
    rows = found.collect()
    assert len(rows) == 10 * queries.count()
    assert all(true[r.query_id, r.vec_id] == pytest.approx(r.similarity, abs=1e-8) for r in rows)
    whole = VEC.vector_topk_coded(index, queries, item="vec_id", query="query_id", k=10, looked_up=50)
    assert {(r.query_id, r.vec_id, r["rank"]) for r in whole.collect()} == {(r.query_id, r.vec_id, r["rank"]) for r in exact.collect()}
    short = queries.select("query_id", F.slice("embedding", 1, 63).alias("embedding"))
    assert VEC.vector_topk_coded(index, short, item="vec_id", query="query_id", k=10).count() == 0
    assert VEC.vector_index(vec.limit(0), item="vec_id", dimensions=64).rows == 0


def test_upsert_counts_repeats_inside_a_batch(spark):
    old = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, v string")
    new = spark.createDataFrame([("a", "p", 1), ("a", "q", 2), ("c", "r", 1), ("c", "s", 3)], "k string, v string, seq int")
    got = {r.k: (r.v, r.action, r.inserted, r.updated) for r in I.upsert(old, new, "k", "seq").collect()}
    assert got == {"a": ("q", "updated", 0, 2), "b": ("y", "kept", 0, 0), "c": ("s", "inserted", 1, 1)}


def test_dedup_of_copies_uses_a_group_limit(spark):
    df = spark.createDataFrame([(i, "s", "same text") for i in range(50)] + [(99, "t", "same text")], "id int, source_id string, raw_text string")
    out = I.fingerprint_dedup(df, order=["id"])
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.id for r in out.collect()) == [0, 99]
    assert out.join(out.select("fingerprint"), "fingerprint", "left_anti").count() == 0
    assert I.fingerprint_dedup(df, order=["id"], existing=out.limit(10)).count() == 0


def test_series_submission_shorter_than_ten_never_replaces(spark):
    rows = [("s", "2024-01-01", i, 1.0) for i in range(12)] + [("s", "2024-01-02", i, 2.0) for i in range(9)]
    df = spark.createDataFrame(rows, "series_id string, ingest_ts string, step int, value double")
    assert {r.value for r in I.latest_submission(df).collect()} == {1.0}


def test_replace_children_and_new_edges(spark):
    old = spark.createDataFrame([("a", "1", "x"), ("b", "1", "y")], "p string, c string, v string")
    new = spark.createDataFrame([("a", "2", "n"), ("a", "2", "m")], "p string, c string, v string")
    got = I.replace_children(old, new, new, "p", ["p", "c"], ["v"])
    assert sorted(map(tuple, got.collect())) == [("a", "2", "m"), ("b", "1", "y")]
    assert I.new_edges(old, old.union(new), ["p", "c"]).count() == 1


def test_replacing_children_sorts_no_children_that_stay(spark):
    old = spark.range(1000).selectExpr("id AS p", "id % 3 AS c", "id AS v")
    new = spark.range(10, 14).selectExpr("id AS p", "7L AS c", "-id AS v")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = I.replace_children(old, new, new.union(new), "p", ["p", "c"], ["v"])
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
        rows = {tuple(r) for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert rows == {(i, i % 3, i) for i in range(1000) if not 10 <= i < 14} | {(i, 7, -i) for i in range(10, 14)}


def test_clearance_of_unknown_analyst_and_service(spark):
    events = spark.createDataFrame([(1, "CUI"), (2, "TS_SCI")], "event_id int, classification string")
    staff = spark.createDataFrame([(7, "SECRET")], "analyst_id int, clearance_level string")
    assert [r.event_id for r in FL.clearance_filter(events, staff, 7).collect()] == [1]
    assert FL.clearance_filter(events, staff, 8).count() == 0
    assert FL.clearance_filter(events, staff, None, role="service").count() == 2
    assert FL.visible_counts(events, staff).collect()[0].visible_events == 1


def test_like_search_takes_a_backslash(spark):
    events = spark.createDataFrame([(1, "a\\b"), (2, "ab"), (3, "A\\Bc")], "sequence int, description string")
    assert [r.sequence for r in FL.like_search(events, keyword="a\\b").collect()] == [1, 3]


def test_budget_prefix_counts_null_and_zero_costs_as_one(spark):
    df = spark.createDataFrame([("k", i, c) for i, c in enumerate([None, 0, 2, 0, 5], 1)], "k string, r int, c int")
    assert [r.r for r in budget_prefix(df, ["k"], "r", F.col("c"), 5).orderBy("r").collect()] == [1, 2, 3, 4]


def test_refused_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (3, [1.0]), (4, [None, 1.0]), (5, [])]
    df = spark.createDataFrame([(f"id{i}", v) for i, v in rows], "id string, embedding array<double>")
    assert {r.id: r.reject_reason for r in VEC.refused_vectors(df, "embedding", 2).collect()} == {
        "id2": "no vector", "id3": "wrong length", "id4": "null element", "id5": "wrong length"}
    hits = VEC.vector_topk(df, df.withColumnRenamed("id", "q"), item="id", query="q", k=3).collect()
    assert sorted((r.q, r.id, r.similarity) for r in hits) == [("id1", "id1", 1.0), ("id3", "id3", 1.0)]


def test_event_list_bounds(spark):
    events = spark.createDataFrame([(1, "OSINT", "FLASH", 1)], "event_id int, source_type string, threat_tier string, ingested_at int")
    with pytest.raises(ValueError):
        FL.event_list(events, limit=101)
    assert FL.event_list(events, source_type="osint", threat_tier="flash").count() == 1
    assert FL.event_list(events, source_type="humint").count() == 0


def test_snapshot_audit(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, None), (4, "d")], "k int, v string")
    assert sorted((r.action, r.row_id) for r in I.snapshot_audit(old, new, "k").collect()) == [
        ("DELETE", "1"), ("INSERT", "4"), ("UPDATE", "2")]


def test_quality_rules_find_and_pass(spark):
    df = spark.createDataFrame([(1, "AB", 5.0, "x"), (2, "a", 50.0, " "), (3, None, None, None)], "id int, code string, n double, t string")
    rules = [*Q.required("code"), Q.matches("code", "^[A-Z]{2}$"), Q.allowed("code", ["AB", "a"]), Q.in_range("n", 0, 10), Q.non_blank("t")]
    got = {r.rule: (r.failed, r.sample) for r in Q.expect(df, rules, "id").collect()}
    assert got == {"code required": (1, "3"), "code format": (2, "2"), "code allowed": (1, "3"), "n range": (2, "2"), "t non-blank": (2, "2")}
    assert Q.row_count(df, 3, 3).first().failed == 0 and Q.row_count(df, 4).first().failed == 1
    assert {(r.column, r.problem) for r in Q.projection(df, ["id", "zip"]).collect()} == {
        ("zip", "missing"), ("code", "unexpected"), ("n", "unexpected"), ("t", "unexpected")}
    assert Q.changed_rows(df, df, "id").count() == 0
    assert [r.id for r in Q.changed_rows(df, df.filter("id < 3"), "id").collect()] == [3]
    doubled = df.union(df.filter("id = 2"))
    assert [r.id for r in Q.changed_rows(df, doubled, "id").collect()] == [2] == [r.id for r in Q.changed_rows(doubled, df, "id").collect()]
    maps = [spark.createDataFrame([(1, {"a": 1, "b": n})], "id int, m map<string,int>") for n in (2, 2, 3)]
    assert Q.changed_rows(maps[0], maps[1], "id").count() == 0 and Q.changed_rows(maps[0], maps[2], "id").count() == 1
    assert Q.top_contains(df, "n", "code", ["zz"]).first().failed == 1
    parents = spark.createDataFrame([(1,)], "pid int")
    assert sorted(r.id for r in Q.orphans(df, parents, "id", "pid").collect()) == [2, 3]


def test_trigram_match_against_all_pairs(spark):
    """Hot grams in every name; the pairs that are looked at stay few, the result is exact."""
    rng = random.Random(4)
    stems = ["steel", "copper", "brass", "tin", "nickel", "tomato", "almond", "azure", "ivory", "lace"]
    names = [f"the {rng.choice(stems)} {rng.choice(stems)} {rng.randrange(10 ** 6)}" for _ in range(300)] + ["", None, "--", "the", "the the"]
    terms = [*rng.sample(names[:300], 30), "tin tin", "the", "", None]

    def grams(text):
        words = re.findall(r"[^\W_]+", (text or "").lower())
        return {f"  {w} "[i:i + 3] for w in words for i in range(len(w) + 1)}

    df_names, df_terms = spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame([(t,) for t in terms], "term string")
    for threshold in (0.3, 0.75, 1.0):
        want = {(a, b): len(grams(a) & grams(b)) / len(grams(a) | grams(b)) for a in names for b in terms if grams(a) and grams(b)}
        want = {k: v for k, v in want.items() if v >= threshold}
        got = {(r.name, r.term): r.similarity for r in FL.trigram_match(df_names, df_terms, "name", "term", threshold).collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    sides = [df.distinct().withColumn("_grams", FL.trigrams(F.col(c))) for df, c in ((df_names, "name"), (df_terms, "term"))]
    pairs = FL.trigram_candidates(*sides, "name", "term", 0.75).count()
    assert len(want) <= pairs <= 0.1 * len(names) * len(set(terms))
    with pytest.raises(ValueError):
        FL.trigram_match(df_names, df_terms, "name", "term", 0)
