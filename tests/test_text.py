"""Text expressions, extraction jobs, readers and retrieval against plain Python."""

import datetime as dt
import hashlib
import json
import math
import re

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import lexemes as L, text as X
from tidewatch.functions.vector import hashed_embedding
from tidewatch.operators import extract as E
from tidewatch.plans import retrieval as R, textsearch as TS
from tidewatch.sources import layout, readers
from tidewatch.suite import REGISTRY, retrieval

SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0       　"


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column.alias("c")).first().c


def test_stems_of_words_that_no_rule_changes_are_passed_by(spark, sf_dir):
    """One look at a word's end says whether any rule can change it; the result is that of all rules."""
    ends = sorted({e for p, _ in L.SUFFIX_RULES for e in re.findall("[a-z]{1,8}", p)})
    made = [f"{w}{e}{x}" for w in ("hop", "stat", "re", "b", "ñan", "xx9") for e in ends for x in ("", "s", "ed", "ly", "ingly")]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.explode(L.words(F.col("text"))).alias("w"))
    words = docs.union(spark.createDataFrame([(w,) for w in made], "w string")).distinct()
    plain = F.col("w")
    for pattern, rest in L.SUFFIX_RULES:
        plain = F.regexp_replace(plain, pattern, rest)
    assert words.where(plain != L.suffix_stem(F.col("w"))).count() == 0
    assert one(spark, "runs runs ran runs", L.terms(F.col("t"))) == ["run", "ran"]


def test_text_match_uses_all_cores_on_one_file(spark, sf_dir):
    assert REGISTRY["fn_text_match"].build(spark, sf_dir).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_words_match_python_split(spark):
    for text in ["", "  ", "a", f"{SPACES}a{SPACES}b  c{SPACES}", "x​y z"]:
        assert one(spark, text, X.words(F.col("t"))) == text.split()
        assert one(spark, text, X.strip(F.col("t"))) == text.strip()


@pytest.mark.parametrize("text,want", [
    ("at 071430ZAPR26 and 010101ZJAN01", dt.datetime(2026, 4, 7, 14, 30)),
    ("071430z apr26", dt.datetime(2026, 4, 7, 14, 30)),
    ("310000ZFEB24", None),
    ("072530ZAPR26", None),
    ("nothing", None),
])
def test_date_time_group(spark, text, want):
    assert one(spark, text, X.dtg_time(X.dtg_match(F.col("t")))) == want


def test_coordinates_and_sign(spark):
    text = "pos 12.5S, 100.25W"
    match = X.position_match(F.col("t"))
    assert one(spark, text, X.coordinate(match, "lat")) == -12.5
    assert one(spark, text, X.coordinate(match, "lon", signed=False)) == 100.25
    assert one(spark, "pos 12S 100W", X.coordinate(match, "lat")) is None


def signals(spark, *texts):
    rows = [("s", t, dt.datetime(2024, 1, 1, 5), {}) for t in texts]
    return spark.createDataFrame(rows, "source_id string, raw_text string, received_at timestamp_ntz, metadata map<string,string>")


def test_signal_job(spark):
    job = E.normalize_signals(signals(spark, " FLASH: quiet sea ", "Movement north 071430ZAPR26", "attack 310000ZFEB24"))
    rows = {r.normalized_text: r for r in job.accepted.collect()}
    # The marker is removed before the keyword test, so it does not raise the tier by itself.
    assert rows["quiet sea"].threat_tier == "MEDIUM" and rows["quiet sea"].event_time == dt.datetime(2024, 1, 1, 5)
    assert rows["Movement north 071430ZAPR26"].threat_tier == "HIGH"
    assert rows["quiet sea"].classification == "SECRET"
    assert [r.reject_reason for r in job.rejected.collect()] == ["impossible date-time group"]
    raw = E.normalize_signals(signals(spark, "FLASH: quiet sea"), classify_on="raw").accepted.first()
    assert raw.threat_tier == "CRITICAL"


def test_report_lines(spark):
    text = "1. 28/0814Z: ALPHA ONE saw a ship on the Port Quarter at 10NM.\n\n2. 3/0841Z: held 8.5 nm at 25 knots\nno number"
    lines = readers.report_lines(spark.createDataFrame([(1, text)], "id int, t string"), "t", "id")
    job = E.report_timeline(lines, default_vessel="D", vessels=["Alpha One"], year=2023, month=5)
    first, second = job.accepted.orderBy("sequence").collect()
    assert (first.vessel, first.bearing, first.distance_nm, first.speed_kts, first.timestamp) == (
        "Alpha One", "port quarter", 10.0, None, "2023-05-28T08:14:00Z")
    assert (second.vessel, second.bearing, second.distance_nm, second.speed_kts, second.timestamp) == (
        "D", None, 8.5, 25.0, "2023-05-03T08:41:00Z")
    assert sorted(r.line for r in job.rejected.collect()) == ["", "no number"]


@pytest.mark.parametrize("text,summary,tier,entities", [
    ("FLASH report. More", "FLASH report.", "FLASH", ["FLASH"]),
    (".starts with a stop", ".starts with a stop", "ROUTINE", []),
    ("   ", "", "ROUTINE", []),
    (None, "", "ROUTINE", []),
    ("x" * 130, "x" * 117 + "...", "ROUTINE", []),
    ("the USS-ABC saw USSABC an AbC TOOLONGWORD", "the USS-ABC saw USSABC an AbC TOOLONGWORD", "ROUTINE", ["USSABC", "AC"]),
])
def test_enrichment(spark, text, summary, tier, entities):
    df = spark.createDataFrame([("OSINT", text)], "source_type string, raw_content string")
    row = E.enrich_events(df).accepted.first()
    assert (row.summary, row.threat_tier, row.entities, row.processing_status) == (summary, tier, entities, "ACCEPTED")


def test_country_documents(spark, tmp_path):
    """Files of an object, a list, or lines, told apart by their content; what is broken is set aside, the rest read."""
    france = {"cca2": "FR", "cca3": "FRA", "name": {"common": "France"}, "population": 68, "languages": {"fra": "French"}, "more": [1]}
    other = {"cca2": "BB", "cca3": "BBB", "population": "many", "currencies": {"X": {"name": "x", "symbol": "$"}}}
    (tmp_path / "deep").mkdir()
    (tmp_path / "list.json").write_text(json.dumps([france, {**other, "capital": None}, 7, None]))
    (tmp_path / "deep" / "one.json").write_text(json.dumps({**france, "cca2": "F2"}, indent=2) + "\n")
    (tmp_path / "lines.json").write_text("\n".join([json.dumps(other), "", '{"cca2": "A', "[1]", '"text"', json.dumps({"cca2": "CC"}) + "\r"]))
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "blank.json").write_text(" \n")
    (tmp_path / "none.json").write_text("[]")
    good, bad = readers.json_documents(spark, str(tmp_path), readers.COUNTRY_DOC)
    rows = {(r.source_path.rsplit("/", 1)[1], r.place): r for r in good.collect()}
    assert set(rows) == {("list.json", 0), ("list.json", 1), ("one.json", 0), ("lines.json", 0), ("lines.json", 5)}
    assert rows["list.json", 0].name.common == "France" and rows["list.json", 0].languages == {"fra": "French"} and rows["list.json", 0].population == 68
    assert rows["lines.json", 0].population is None and rows["lines.json", 0].currencies["X"].symbol == "$" and rows["lines.json", 5].cca2 == "CC"
    assert sorted((r.source_path.rsplit("/", 1)[1], r.place, r.payload, r.reject_reason) for r in bad.collect()) == [
        ("lines.json", 2, '{"cca2": "A', "no JSON"), ("lines.json", 3, "[1]", "no object"), ("lines.json", 4, '"text"', "no object"),
        ("list.json", 2, "7", "no object"), ("list.json", 3, "null", "no object")]
    assert readers.country_documents(spark, str(tmp_path), "bbb").count() == 2
    assert readers.country_documents(spark, str(tmp_path)).count() == 5


def test_normalize_countries(spark, tmp_path):
    doc = {
        "name": {"common": "A", "official": "Aa"}, "cca2": " AA ", "cca3": "AAA", "region": "R", "capital": [],
        "population": 5, "languages": {"x": "X"}, "currencies": {"c": {"name": "C", "symbol": "$"}}, "borders": ["BBB", "CCC"],
    }
    (tmp_path / "list.json").write_text(json.dumps([doc, {"cca2": "", "cca3": "ZZZ"}]))
    (tmp_path / "single.json").write_text(json.dumps({"cca2": "BB", "cca3": "BBB"}, indent=1))
    t = E.normalize_countries(readers.country_documents(spark, str(tmp_path)))
    rows = {r.cca2: r for r in t.countries.collect()}
    assert rows["AA"].capital is None and rows["AA"].official_name == "Aa" and rows["BB"].common_name == ""
    assert t.borders.count() == 2 and t.languages.count() == 1 and t.currencies.first().symbol == "$"
    assert [r.cca3 for r in t.rejected.collect()] == ["ZZZ"]


def test_text_files_and_quarantine(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo")
    (tmp_path / "b.MD").write_text("# head")
    (tmp_path / "c.pdf").write_bytes(b"%PDF")
    good, bad = readers.text_files(spark, str(tmp_path))
    assert sorted(r.text for r in good.collect()) == ["# head", "one\ntwo"]
    assert [r.reject_reason for r in bad.collect()] == ["refused file type .pdf"]


def test_monthly_layout_prunes_partitions(spark, tmp_path):
    df = spark.range(100).select("id", F.expr("TIMESTAMP_NTZ '2020-01-15 00:00:00' + make_dt_interval(cast(id as int) * 10)").alias("occurred_at"))
    layout.write_monthly(df, str(tmp_path / "m"))
    out = layout.read_months(spark, str(tmp_path / "m"), since="2021-06", until="2021-07")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month" in plan
    assert out.count() == df.filter("occurred_at >= '2021-06-01' AND occurred_at < '2021-08-01'").count()


def test_time_bounds_reach_the_scan(spark, sf_dir):
    from tidewatch.suite import REGISTRY

    plan = REGISTRY["lookback_filter"].build(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "o_totalprice" not in plan


def chunks_of(text):
    words = text.split()
    out = [" ".join(words[s:s + 512]) for s in range(0, len(words), 448)]
    return [c for c in out if len(c.strip()) > 50]


@pytest.mark.parametrize("n", [0, 5, 448, 449, 512, 900, 1000])
def test_chunks(spark, n):
    text = " ".join(f"w{i}" for i in range(n))
    got = R.chunk_documents(spark.createDataFrame([(1, text)], "id int, t string"), key="id", text="t").orderBy("chunk_index").collect()
    assert [r.chunk_text for r in got] == chunks_of(text)
    assert [r.chunk_index for r in got] == list(range(len(got)))


CORPUS = ["the cat sat on the mat", "The dog the", "a bird", "", "cat cat dog", "the the the end"]
QUESTIONS = ["cat the the", "dog", "missing words"]


def brute_bm25(docs, question):
    tokens = [d.lower().split() for d in docs]
    n, mean_len = len(docs), sum(map(len, tokens)) / len(docs)
    df = {}
    for t in tokens:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    idf = {w: math.log(n - f + 0.5) - math.log(f + 0.5) for w, f in df.items()}
    floor = 0.25 * sum(idf.values()) / len(idf)
    idf = {w: floor if v < 0 else v for w, v in idf.items()}
    return [
        sum(idf.get(w, 0) * t.count(w) * 2.5 / (t.count(w) + 1.5 * (0.25 + 0.75 * len(t) / mean_len)) for w in question.lower().split())
        for t in tokens
    ]


def test_bm25(spark):
    docs = spark.createDataFrame(list(enumerate(CORPUS)), "id bigint, t string")
    asked = spark.createDataFrame(list(enumerate(QUESTIONS)), "q bigint, question string")
    index = R.bm25_index(docs, key="id", text="t")
    got = {(r.q, r.id): r.score for r in R.bm25_topk(index, asked, key="id", query="q", text="question", k=10).collect()}
    want = {(q, i): s for q, text in enumerate(QUESTIONS) for i, s in enumerate(brute_bm25(CORPUS, text)) if s > 0}
    assert got.keys() == want.keys()
    for key, score in want.items():
        assert got[key] == pytest.approx(score)


PAPERS = ["The ships sailed, and the crews were singing songs of ships.", "Nothing here", None, "", "the of and",
          "Crew one. A ship; then nine other words stand between it and what the sailors call a crew", "ship crew ship crew ship",
          "Ünïcode ships crew2 and crew", "crews " * 3000 + "ship"]
SEARCHES = ["ship crew", "The SHIPS of crews!", "the and", "", None, "sang", "ships singing nothing", "crews"]


def plain_terms(text):
    return [(i, w) for i, w in enumerate(re.findall(r"[^\W_]+", (text or "").lower()), 1) if w not in L.STOP_WORDS]


def brute_covers(places, wanted):
    """Score of the places {place: term} of one text, by trying all stretches."""
    hits = [(p, t) for p, t in sorted(places.items()) if t in wanted]
    full = [(a, b) for a in range(len(hits)) for b in range(a, len(hits)) if {t for _, t in hits[a:b + 1]} == wanted]
    best = [(a, b) for a, b in full if not any((c, d) != (a, b) and a <= c and d <= b for c, d in full)]
    return sum(0.1 / (1 + hits[b][0] - hits[a][0] - (b - a)) for a, b in best)


def test_text_search_by_cover_density(spark):
    """Positions, stop words and stems; against all stretches of each text, tried one by one."""
    docs = spark.createDataFrame(list(enumerate(PAPERS)), "id bigint, t string").withColumn("term", F.lit("x"))
    asked = spark.createDataFrame(list(enumerate(SEARCHES)), "q bigint, question string")
    vocabulary = sorted({w for t in [*PAPERS, *SEARCHES] for _, w in plain_terms(t)})
    stems = spark.createDataFrame([(w,) for w in vocabulary], "w string").select("w", L.suffix_stem(F.col("w")).alias("s"))
    stem = {r.w: r.s for r in stems.collect()}
    assert stem["ships"] == "ship" and stem["sailed"] == "sail" and stem["singing"] == "sing" and stem["songs"] == "song"
    want = {}
    for q, question in enumerate(SEARCHES):
        wanted = {stem[w] for _, w in plain_terms(question)}
        for i, text in enumerate(PAPERS):
            places = {p: stem[w] for p, w in plain_terms(text)}
            if wanted and wanted <= set(places.values()):
                if len(places) > 1000:  # one stretch for two terms, and each occurrence for one
                    want[q, i] = 0.1 if len(wanted) == 2 else 0.1 * 3000
                else:
                    want[q, i] = brute_covers(places, wanted)
    index = TS.text_index(docs, key="id", text="t")
    found = TS.keyword_search(index, asked, key="id", query="q", text="question").collect()
    got = {(r.q, r.id): r.score for r in found}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    for q in range(len(SEARCHES)):
        ordered = sorted((k for k in want if k[0] == q), key=lambda k: (-round(want[k], 9), k))
        assert [r.id for r in sorted((r for r in found if r.q == q), key=lambda r: r["rank"])] == [i for _, i in ordered]
    only = docs.where("id < 6").select("id")
    assert {(r.q, r.id) for r in TS.keyword_search(index, asked, key="id", query="q", text="question", only=only).collect()} == {
        k for k in want if k[1] < 6}
    plain = TS.text_index(docs, key="id", text="t", stem=lambda w: w)
    assert {r.id for r in TS.keyword_search(plain, asked.where("q = 0"), key="id", query="q", text="question").collect()} == {5, 6}
    empty = TS.text_index(docs.limit(0), key="id", text="t")
    assert TS.keyword_search(empty, asked, key="id", query="q", text="question").count() == 0


def invented(spark, rows: int, words: int):
    """Documents of invented words, each with the word of its number modulo ten."""
    text = F.concat_ws(" ", F.concat(F.lit("nr"), (F.col("id") % 10).cast("string")), F.transform(
        F.sequence(F.lit(1), F.lit(words)), lambda i: F.concat(F.lit("w"), F.hex(F.xxhash64(F.col("id"), i)))))
    return spark.range(rows).select("id", text.alias("t"))


def joins_of(df) -> list[str]:
    return re.findall(r"(SortMergeJoin|ShuffledHashJoin|BroadcastHashJoin)", df._jdf.queryExecution().executedPlan().toString())


def test_text_search_shuffles_neither_index_nor_words(spark):
    """A row per document and one per distinct word are stored, and what is asked for goes to the texts."""
    docs = invented(spark, 200, 100)
    asked = spark.createDataFrame([(0, "nr3"), (1, "nr4 nowhere"), (2, "nr5 nr5")], "q bigint, question string")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 50_000)
    try:
        index = TS.text_index(docs, key="id", text="t")
        found = TS.keyword_search(index, asked, key="id", query="q", text="question")
        assert set(joins_of(found)) == {"BroadcastHashJoin"}
        assert {(r.q, r.id) for r in found.collect()} == {(q, i) for q, n in ((0, 3), (2, 5)) for i in range(200) if i % 10 == n}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert index.texts.count() == 200 and index.vocabulary.count() == 200 * 100 + 10


def test_term_statistics_shuffle_no_words(spark):
    """Terms of several words, long texts, keys that come again or are null; the texts only meet the few keys that come again."""
    texts = [(0, "The ships sailed; a ship SAILS."), (1, "ships"), (1, "a ship sails, ship"), (1, None), (None, "sailing"), (None, "sail"), (2, None),
             (3, "the the"), (4, ""), (5, "harbour ships ship " * 100_000), (6, "sailed harbours harbour"), (7, "x1 ship")]
    docs = spark.createDataFrame(texts, "id bigint, t string").unionByName(invented(spark, 100, 50).withColumn("id", F.col("id") + 100))
    words = [(r.id, p, w) for r in docs.collect() for p, w in plain_terms(r.t)]
    stems = spark.createDataFrame([(w,) for w in {w for _, _, w in words}], "w string").select("w", L.suffix_stem(F.col("w")).alias("s"))
    stem, seen = {r.w: r.s for r in stems.collect()}, {}
    for key, p, w in words:
        seen.setdefault(stem[w], []).append((key, p))
    want = {t: (len({k for k, _ in at}), len(at), sum(p for _, p in at)) for t, at in seen.items()}
    assert want["sail"] == (4, 6, 15) and want["ship"][0] == 4
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 50_000)
    try:
        found = TS.term_statistics(TS.text_index(docs, key="id", text="t"))
        assert joins_of(found) == ["BroadcastHashJoin"]
        got = {r.term: (r.documents, r.places, r.place_sum) for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert got == want
    assert TS.term_statistics(TS.text_index(docs.limit(0), key="id", text="t")).count() == 0


def test_postings_and_texts_meet_stored_questions_and_hits(spark):
    """Neither the postings nor the texts are shuffled for a few questions, and hits are searched for once."""
    docs = invented(spark, 200, 100)
    asked = spark.createDataFrame([(0, "nr3 nr3 nowhere"), (1, "nowhere")], "q bigint, question string")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 50_000)
    try:
        index = R.bm25_index(docs, key="id", text="t")
        found = R.bm25_topk(index, asked, key="id", query="q", text="question", k=7)
        assert joins_of(found) == ["BroadcastHashJoin"]
        assert [(r.q, r.id) for r in found.orderBy("q", "rank").collect()] == [(0, 3 + 10 * i) for i in range(7)]
        hits = R.hybrid_search(index, hashed_embedding(docs, "id", "t"), asked, key="id", query="q", query_text="question", top_k=5, depth=9)
        assert joins_of(docs.repartition(2).join(hits, "id")) == ["BroadcastHashJoin"]
        assert hits.groupBy("q").count().orderBy("q").collect() == [(0, 5), (1, 5)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_fusion_keeps_single_list_hits(spark):
    a = spark.createDataFrame([("q", 1, 1), ("q", 2, 2)], "q string, id int, rank int")
    b = spark.createDataFrame([("q", 2, 1), ("q", 3, 2)], "q string, id int, rank int")
    got = R.rrf_fuse(a, b, key="id", query="q", k=2).orderBy("rrf_rank").collect()
    assert [(r.id, r.vector_rank, r.text_rank) for r in got] == [(2, 2, 1), (1, 1, None)]
    assert got[0].rrf_score == pytest.approx(1 / 62 + 1 / 61)


def test_context_of_chunks_and_events(spark):
    asked = spark.createDataFrame([(1,), (2,)], "q int")
    hits = spark.createDataFrame([(1, 1, "aaa", "p1"), (1, 2, "b" * 50, "p2"), (1, 3, "c", "p3")], "q int, rank int, t string, src string")
    row = R.context_pack_chunks(hits, asked.filter("q = 1"), query="q", rank="rank", text="t", source="src", budget=40).first()
    assert (row.context, row.citations, row.cited, row.chunks_used) == ("[source_1]\naaa\n", "[source_1] p1", 1, 3)
    event = [(1, 1, "s", "osint", dt.datetime(2024, 1, 2), "CUI", "text", 0.5)]
    events = spark.createDataFrame(event, "q int, rank int, source_id string, int_type string, event_time timestamp_ntz, classification string, excerpt string, rrf_score double")
    full = "[SOURCE: s | OSINT | 2024-01-02T00:00:00 | CLASSIFICATION: CUI]\ntext\n"
    assert R.context_pack_events(events, asked.filter("q = 1"), query="q", rank="rank", budget=len(full)).first().context == full
    short = R.context_pack_events(events, asked.filter("q = 1"), query="q", rank="rank", budget=len(full) - 1).first()
    assert (short.context, short.confidence, short.cited, short.total_events_retrieved) == ("", 0.0, 0, 1)
    assert R.context_pack_events(events, asked, query="q", rank="rank").filter("q = 1").first().citations == (
        "s | 2024-01-02T00:00:00 | CUI | 0.500000 | text")
    # a question without hits is answered with nothing
    none = R.context_pack_events(events, asked, query="q", rank="rank").filter("q = 2").first()
    assert (none.context, none.citations, none.confidence, none.cited, none.total_events_retrieved) == ("", "", 0.0, 0, 0)
    none = R.context_pack_chunks(hits, asked, query="q", rank="rank", text="t", source="src").filter("q = 2").first()
    assert (none.context, none.citations, none.cited, none.chunks_used) == ("", "", 0, 0)
    assert sorted(map(tuple, R.retrieval_score_summary(events, asked, query="q").collect())) == [(1, 0.5, 1), (2, 0.0, 0)]


def test_keyword_recall(spark):
    rows = [(["Rank", "rrf"], "uses rank fusion"), ([], "x"), (["a"], None)]
    got = R.keyword_recall(spark.createDataFrame(rows, "k array<string>, a string"), keywords="k", answer="a")
    assert [(r.keyword_recall, r.passed) for r in got.collect()] == [(0.5, True), (1.0, True), (0.0, False)]
    assert R.recall_summary(got).first().pass_rate == pytest.approx(2 / 3)


def test_embedding_of_blank_text_is_zero(spark):
    df = hashed_embedding(spark.createDataFrame([(1, "a b a"), (2, " ")], "id int, t string"), "id", "t")
    got = {r.id: r.embedding for r in df.collect()}
    assert sum(x * x for x in got[1]) == pytest.approx(1) and got[2] == [0.0] * 64


def test_embedding_counts_where_a_text_is_read(spark):
    """No word is shuffled and nothing joined; rows of one key share the vector of their texts, rows without key or text get zeros."""
    rows = [(1, "Ships\u00a0sail a a A"), (1, "sail north"), (2, None), (None, "lost"), (3, "\u3000 x\x1cy \x85 x")]
    df = hashed_embedding(spark.createDataFrame(rows, "id int, t string"), "id", "t")
    assert joins_of(df) == [] and "explode(_t" not in df._jdf.queryExecution().optimizedPlan().toString()

    def unit(words):
        counts = [0] * 64
        for w in words:
            counts[int(hashlib.md5(w.encode()).hexdigest()[:4], 16) % 64] += 1
        return [c / math.sqrt(sum(x * x for x in counts)) if any(counts) else 0.0 for c in counts]

    both = unit(["ships", "sail", "a", "a", "a", "sail", "north"])
    want = [(1, both), (1, both), (2, unit([])), (None, unit([])), (3, unit(["x", "y", "x"]))]
    assert sorted(map(repr, ((r.id, r.embedding) for r in df.collect()))) == sorted(map(repr, want))


def test_event_search_indexes_the_wanted_events(spark, tmp_path):
    """Neither postings nor the vectors and words of events that cannot be hits are made for it."""
    rows = [(i, f"word{i % 3} common text {i}", "en" if i % 2 else "fr", "web") for i in range(0, 400, 3)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "common text"), (2, "text 99")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    hits = REGISTRY["hybrid_search_events"].build(spark, str(tmp_path)).collect()
    wanted = {i for i, *_ in rows if i % 2 and 78 <= i <= 1218}
    kept = {name: made for (_, d, name), made in retrieval._STORED.items() if d == str(tmp_path)}
    assert len(hits) == 40 and {r.event_id for r in hits} <= wanted and 99 in {r.event_id for r in hits if r.query_id == 2 and r.rrf_rank == 1}
    assert sorted(kept) == ["terms of wanted events", "vectors of wanted events"]
    assert kept["terms of wanted events"].texts.count() == kept["vectors of wanted events"].count() == len(wanted)
