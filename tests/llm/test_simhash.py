import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest_llm import docs_of
from tidewatch.llm import simhash
from tidewatch.llm.components import components


def brute_fingerprint(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    values = sorted(set(prints))
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {v: find(v) for v in values}


def near_values(seed, n):
    rng = random.Random(seed)
    values = [0, (1 << 64) - 1, 1 << 63, 1]
    while len(values) < n:
        base = rng.getrandbits(64) if rng.random() < 0.3 else rng.choice(values)
        for _ in range(rng.randint(0, 3)):
            base ^= 1 << rng.randrange(64)
        values.append(base)
    return values


def test_codes_are_perfect():
    for code in simhash.CODES:
        assert (simhash.error_table(*code, 2)[0][1] == 1).all()


def test_anchors_within_reach():
    values = np.array(near_values(1, 60), np.uint64)
    tables = {extra: [simhash.error_table(*c, extra) for c in simhash.CODES] for extra in (0, 2)}
    homes = {int(values[i]): int(a) for index, anchor in simhash.reachable(values, 0, tables[0]) for i, a in zip(index, anchor)}
    near = {(int(values[i]), int(a)) for index, anchor in simhash.reachable(values, 2, tables[2]) for i, a in zip(index, anchor)}
    for a in homes:
        assert ((a & ((1 << 61) - 1)) ^ homes[a]).bit_count() <= 7
        for b in homes:
            if (a ^ b).bit_count() <= 2:
                assert (b, homes[a]) in near


@pytest.mark.parametrize("crowd", [500, 0])
def test_links_are_complete(spark, monkeypatch, crowd):
    """With and without pairs: with a crowd of 0 every anchor is linked over the points between."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    values = near_values(2, 700)
    df = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in set(values)], "f long")
    edges = simhash.links(df)
    assert edges.where("bit_count(a ^ b) > 2").count() == 0
    found = {int(np.int64(r.node).view(np.uint64)): r.root for r in components(edges).collect()}
    expected = brute_components(values)
    groups = {}
    for v, root in expected.items():
        groups.setdefault(root, set()).add(v)
    for members in groups.values():
        assert len({found.get(v, v) for v in members}) == 1
    assert len({found[v] for v in found}) == sum(len(g) > 1 for g in groups.values())


def broadcast_rows(df):
    """Runs ``df``; the numbers of rows that its plan broadcast."""
    planned = df._jdf.queryExecution()
    planned.toRdd().count()

    def walk(plan):
        if plan.nodeName() == "AdaptiveSparkPlan":
            yield from walk(plan.executedPlan())
        elif "QueryStage" in plan.nodeName():
            yield from walk(plan.plan())
        elif plan.nodeName() == "BroadcastExchange":
            yield plan.metrics().apply("numOutputRows").value()
        for i in range(plan.children().size()):
            yield from walk(plan.children().apply(i))

    return list(walk(planned.executedPlan()))


@pytest.mark.parametrize("crowd", [500, 0])
def test_replicas_and_points_are_never_broadcast(spark, monkeypatch, crowd):
    """A fingerprint has some 150 replicas and 65 points, which a plan takes for one row; with a crowd of 0 there are points."""
    values = {int(np.uint64(v).view(np.int64)) for v in near_values(3, 400)}
    met, store = [], simhash.store
    monkeypatch.setattr(simhash, "CROWD", crowd)
    monkeypatch.setattr(simhash, "store", lambda df, purpose: met.append(df) or store(df, purpose))
    edges = simhash.links(spark.createDataFrame([(v,) for v in values], "f long"))
    assert len(met) == 1 and edges.count() > 0
    for df in (*met, edges):
        assert max(broadcast_rows(df), default=0) <= len(values)


def test_documents_against_brute_force(spark, make_docs, sf_dir):
    rows = [(r.doc_id, r.text) for r in docs_of(spark, sf_dir).collect()]
    rows += [(10_000 + i, t.replace(" ", " x ", 1) if i % 2 else t.upper()) for i, (_, t) in enumerate(rows[:60])]
    rows += [(20_001, ""), (20_000, None), (20_002, " \n"), (20_003, "One word"), (20_004, "one\tWORD"), (20_004, "one\tWORD")]
    found = simhash.near_duplicates(make_docs(rows)).select("doc_id", simhash.as_hex(F.col("f")).alias("h"), "component_id").collect()
    prints = {(d, t): brute_fingerprint(t) for d, t in rows}
    roots = brute_components(prints.values())
    least = {}
    for (d, _), f in prints.items():
        least[roots[f]] = min(d, least.get(roots[f], d))
    expected = sorted((d, f"{prints[d, t]:016x}", least[roots[prints[d, t]]]) for d, t in rows)
    assert sorted((r.doc_id, r.h, r.component_id) for r in found) == expected


def test_one_of_each_group_stays(spark, make_docs, odd):
    text = "a text of some words that is long enough to be itself"
    rows = [(9, text), (3, text.upper()), (None, text), (3, text), (4, "another one"), (None, None), (None, ""), (None, "third kind of text")]
    docs = make_docs(rows, extra=True)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, (r.text or "").lower()) for r in kept.collect()), key=str) == sorted(
        [(3, text), (4, "another one"), (None, ""), (None, "third kind of text")], key=str)
    assert simhash.near_duplicates(odd).count() == odd.count()
    assert simhash.keep_one(odd.limit(0)).count() == 0 == simhash.near_duplicates(odd.limit(0)).count()


def test_many_copies_are_one_node(spark):
    copies = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("the very same text again").alias("text"))
    assert simhash.near_duplicates(copies).select("component_id", "f").distinct().collect()[0].component_id == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100)] + [(1000, i) for i in range(1001, 1300)] + [(5, 5)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(101)}, **{i: 1000 for i in range(1000, 1300)}}
