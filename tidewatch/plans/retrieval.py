"""Chunking, keyword ranking, fusion and context packing for batches of queries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidewatch.functions import text as X
from tidewatch.functions.scalar import computed_once, exact_round
from tidewatch.functions.vector import hashed_embedding
from tidewatch.operators.ingest import first_per_key, without_stored
from tidewatch.operators.vectors import vector_topk
from tidewatch.operators.windows import budget_prefix
from tidewatch.plans.textsearch import TextIndex, keyword_search
from tidewatch.session import dealt_by, materialize

# BM25 parameters, fusion constant, chunk and context sizes.
K1, B, EPSILON = 1.5, 0.75, 0.25
RRF_K = 60
CHUNK_WORDS, CHUNK_OVERLAP, SHORTEST_CHUNK = 512, 64, 50
CONTEXT_CHARS = 12_000
EVENT_CONTEXT_CHARS = 6_000 * 4

# Text layout of contexts and prompts.
CHUNK_LABEL = "[source_%d]"
EVENT_HEADER = "[SOURCE: %s | %s | %s | CLASSIFICATION: %s]\n"
EVENT_SEPARATOR = "\n---\n"
EVENT_CITATION = "%s | %s | %s | %.6f | %s"
EVENT_PROMPT = "Reported events:\n\n%s\n\nQuestion: %s\n\nCited reports:\n%s"
PROMPT = "Document excerpts:\n\n%s\n\nQuestion: %s\n\nSources:\n%s"


def chunk_documents(
    documents: DataFrame, *, key: str, text: str,
    size: int = CHUNK_WORDS, overlap: int = CHUNK_OVERLAP, shortest: int = SHORTEST_CHUNK,
) -> DataFrame:
    """``(key, chunk_index, chunk_text)``: windows of ``size`` words stepping ``size - overlap``.

    The index counts the chunks that are long enough to keep.
    """
    step = size - overlap
    split = computed_once(documents.select(key, text), _w=X.words(F.col(text))).select(key, "_w")
    starts = F.when(F.size("_w") > 0, F.sequence(F.lit(0), F.size("_w") - 1, F.lit(step)))
    windows = F.transform(starts, lambda s: F.array_join(F.slice(F.col("_w"), s + 1, F.lit(size)), " "))
    kept = F.filter(windows, lambda c: F.length(c) > shortest)
    return split.select(key, F.posexplode(kept).alias("chunk_index", "chunk_text"))


def chunk_dedup(chunks: DataFrame, *, source: str, existing: DataFrame | None = None) -> DataFrame:
    """First chunk of every content over the whole corpus, minus what is stored."""
    hashed = chunks.withColumn("content_hash", F.sha2("chunk_text", 256))
    return without_stored(first_per_key(hashed, ["content_hash"], [source, "chunk_index"]), existing, "content_hash")


@dataclass(frozen=True)
class Bm25Index:
    """Corpus statistics as tables.

    ``postings`` is ``(key, doc_len, term, tf)``, ``terms`` is ``(term, df, idf)``
    and ``stats`` is one row of corpus size and mean length.
    """

    postings: DataFrame
    terms: DataFrame
    stats: DataFrame


def bm25_index(corpus: DataFrame, *, key: str, text: str, epsilon: float = EPSILON) -> Bm25Index:
    """Index of lower-cased white-space tokens.

    A negative idf is replaced by ``epsilon`` times the mean idf of all terms.
    The length travels with each posting, so scoring needs no join on documents.
    The postings are stored once: every later step reads them, none tokenises again.
    """
    tokenised = computed_once(dealt_by(corpus.select(key, text), key), _tokens=X.tokens(F.col(text)))
    # The length is a column of its own before the explode, or every term row would carry the whole array.
    tokenised = tokenised.select(key, F.size("_tokens").cast("bigint").alias("doc_len"), "_tokens")
    postings = (
        tokenised.select(key, "doc_len", F.explode("_tokens").alias("term"))
        .groupBy(key, "doc_len", "term").agg(F.count(F.lit(1)).alias("tf"))
    )
    postings = materialize(postings, "postings")
    size = corpus.agg(F.count(F.lit(1))).scalar()
    stats = postings.agg(F.sum("tf").alias("_tokens")).select(
        size.alias("documents"), (F.col("_tokens") / size).alias("mean_len")
    )
    idf = F.ln(size - F.col("df") + 0.5) - F.ln(F.col("df") + 0.5)
    frequency = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    frequency = materialize(frequency, "frequency")
    mean = frequency.agg(F.avg(idf)).scalar()
    terms = frequency.select("term", "df", F.when(idf < 0, F.lit(epsilon) * mean).otherwise(idf).alias("idf"))
    return Bm25Index(postings, terms, stats)


def query_terms(queries: DataFrame, *, query: str, text: str) -> DataFrame:
    """``(query, term, qf)``: how often each token occurs in a query."""
    return queries.select(query, F.explode(X.tokens(F.col(text))).alias("term")).groupBy(query, "term").agg(
        F.count(F.lit(1)).alias("qf")
    )


def bm25_scores(
    index: Bm25Index, queries: DataFrame, *, key: str, query: str, text: str, k1: float = K1, b: float = B,
) -> DataFrame:
    """``(query, key, score)`` for documents that share a term with a query.

    The idf joins the short query side; what meets the postings is a stored list of
    query terms, whose size Spark knows and which it broadcasts when it is small, so the postings
    are not shuffled, and those of one document are scored and partly summed where they are.
    """
    weighted = materialize(query_terms(queries, query=query, text=text).join(index.terms, "term"), "query-terms")
    mean_length = index.stats.select("mean_len").scalar()
    tf = F.col("tf")
    norm = k1 * (1 - b + b * F.col("doc_len") / mean_length)
    part = F.col("qf") * F.col("idf") * tf * (k1 + 1) / (tf + norm)
    return index.postings.join(weighted, "term").groupBy(query, key).agg(F.sum(part).alias("score"))


def ranked(scores: DataFrame, *, key: str, query: str, k: int, score: str = "score", digits: int = 9) -> DataFrame:
    """Best ``k`` per query; scores equal to ``digits`` places are ties, broken by key."""
    w = W.partitionBy(query).orderBy(exact_round(F.col(score), digits).desc(), key)
    return scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def bm25_topk(index: Bm25Index, queries: DataFrame, *, key: str, query: str, text: str, k: int) -> DataFrame:
    scores = bm25_scores(index, queries, key=key, query=query, text=text).filter("score > 0")
    return ranked(scores, key=key, query=query, k=k).select(query, key, "score", "rank")


def rrf_fuse(vector_hits: DataFrame, text_hits: DataFrame, *, key: str, query: str, k: int, constant: int = RRF_K) -> DataFrame:
    """Reciprocal rank fusion of two ranked lists; a hit of one list alone is kept."""
    a = vector_hits.select(query, key, F.col("rank").alias("vector_rank"))
    b = text_hits.select(query, key, F.col("rank").alias("text_rank"))

    def share(rank: str) -> Column:
        return F.coalesce(1.0 / (constant + F.col(rank)), F.lit(0.0))

    fused = a.join(b, [query, key], "full").withColumn("rrf_score", share("vector_rank") + share("text_rank"))
    w = W.partitionBy(query).orderBy(F.desc("rrf_score"), key)
    return fused.withColumn("rrf_rank", F.row_number().over(w)).filter(F.col("rrf_rank") <= k)


def hybrid_search(
    index: Bm25Index | TextIndex, vectors: DataFrame, queries: DataFrame, *, key: str, query: str, query_text: str,
    top_k: int, depth: int, query_vectors: DataFrame | None = None, only: DataFrame | None = None,
) -> DataFrame:
    """Vector and text lists of ``depth``, fused to ``top_k`` hits per query.

    The kind of index says how texts are searched: any shared term, ranked by BM25, or
    all terms, ranked by cover density. ``vectors`` and ``query_vectors`` are ``(key, embedding)``; for queries without
    vectors the hashed stand-in is computed. ``only`` has the keys that may be hits, of either list. The
    hits are stored: what joins them to whole texts, more than once, neither searches again nor shuffles the texts.
    """
    if query_vectors is None:
        query_vectors = hashed_embedding(queries, query, query_text)
    if only is not None:
        vectors = vectors.join(only.select(key), key, "left_semi")
    near = vector_topk(vectors, query_vectors, item=key, query=query, k=depth)
    if isinstance(index, TextIndex):
        found = keyword_search(index, queries, key=key, query=query, text=query_text, k=depth, only=only)
    elif only is None:
        found = bm25_topk(index, queries, key=key, query=query, text=query_text, k=depth)
    else:
        raise ValueError("BM25 weighs terms over the whole index; build one of the rows that are wanted")
    return materialize(rrf_fuse(near, found, key=key, query=query, k=top_k), "fused")


def _joined(column: str, rank: str, separator: str) -> Column:
    ordered = F.sort_array(F.collect_list(F.struct(rank, column)))
    return F.array_join(F.transform(ordered, lambda x: x[column]), separator)


def context_pack_chunks(
    hits: DataFrame, questions: DataFrame, *, query: str, rank: str, text: str, source: str, budget: int = CONTEXT_CHARS
) -> DataFrame:
    """Context and citations of every question from the ranked prefix that fits the budget; empty without hits."""
    label = F.format_string(CHUNK_LABEL, rank)
    snippets = hits.withColumn("_snippet", F.concat(label, F.lit("\n"), F.col(text), F.lit("\n"))).withColumn(
        "_citation", F.concat(label, F.lit(" "), F.col(source).cast("string"))
    )
    packed = budget_prefix(snippets, [query], rank, F.length("_snippet"), budget)
    parts = packed.groupBy(query).agg(
        _joined("_snippet", rank, "\n").alias("context"),
        _joined("_citation", rank, "\n").alias("citations"),
        F.count(F.lit(1)).alias("cited"),
    )
    used = hits.groupBy(query).agg(F.count(F.lit(1)).alias("chunks_used"))
    return questions.select(query).join(used, query, "left").join(parts, query, "left").select(
        query, F.coalesce("context", F.lit("")).alias("context"), F.coalesce("citations", F.lit("")).alias("citations"),
        F.coalesce("cited", F.lit(0)).alias("cited"), F.coalesce("chunks_used", F.lit(0)).alias("chunks_used"),
    )


def context_pack_events(
    hits: DataFrame, questions: DataFrame, *, query: str, rank: str, budget: int = EVENT_CONTEXT_CHARS
) -> DataFrame:
    """Event context of every question: header and excerpt per hit, one newline counted between parts.

    A citation names source, time, label, score and excerpt of a hit that is in the
    context. A question without hits has an empty context and confidence 0.
    """
    when = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss")
    header = F.format_string(EVENT_HEADER, "source_id", F.upper("int_type"), when, "classification")
    citation = F.format_string(EVENT_CITATION, "source_id", when, "classification", "rrf_score", "excerpt")
    parts = hits.withColumn("_part", F.concat(header, "excerpt", F.lit("\n"))).withColumn("_citation", citation)
    packed = budget_prefix(parts, [query], rank, F.length("_part") + 1, budget + 1)
    kept = packed.groupBy(query).agg(
        _joined("_part", rank, EVENT_SEPARATOR).alias("context"),
        _joined("_citation", rank, "\n").alias("citations"),
        F.avg("rrf_score").alias("confidence"),
        F.count(F.lit(1)).alias("cited"),
    )
    found = hits.groupBy(query).agg(F.count(F.lit(1)).alias("total_events_retrieved"))
    return questions.select(query).join(found, query, "left").join(kept, query, "left").select(
        query, F.coalesce("context", F.lit("")).alias("context"), F.coalesce("citations", F.lit("")).alias("citations"),
        F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.coalesce("cited", F.lit(0)).alias("cited"),
        F.coalesce("total_events_retrieved", F.lit(0)).alias("total_events_retrieved"),
    )


def prompt_batch(contexts: DataFrame, questions: DataFrame, *, query: str, question: str, layout: str = PROMPT) -> DataFrame:
    """Prompt text per question, from either kind of context; generating the answer is not part of the library."""
    prompt = F.format_string(layout, "context", question, "citations")
    return contexts.join(questions.select(query, question), query).select(query, prompt.alias("prompt"))


def keyword_recall(answers: DataFrame, *, keywords: str, answer: str, pass_mark: float = 0.5) -> DataFrame:
    """Share of the expected keywords found in the answer; a missing answer is a failed one."""
    low = F.lower(answer)
    hits = F.size(F.filter(F.col(keywords), lambda k: low.contains(F.lower(k))))
    wanted = F.size(keywords)
    recall = F.when(F.col(answer).isNull(), 0.0).when(wanted == 0, 1.0).otherwise(hits / wanted)
    return answers.withColumn("keyword_recall", recall).withColumn("passed", F.col("keyword_recall") >= pass_mark)


def recall_summary(evaluated: DataFrame) -> DataFrame:
    return evaluated.agg(
        F.count(F.lit(1)).alias("questions"),
        F.count_if("passed").alias("passed"),
        (F.count_if("passed") / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("pass_rate"),
    )


def retrieval_score_summary(hits: DataFrame, questions: DataFrame, *, query: str, score: str = "rrf_score") -> DataFrame:
    """Mean score and number of hits of every question; both 0 without hits."""
    found = hits.groupBy(query).agg(F.avg(score).alias("confidence"), F.count(F.lit(1)).alias("retrieved"))
    return questions.select(query).join(found, query, "left").fillna({"confidence": 0.0, "retrieved": 0})
