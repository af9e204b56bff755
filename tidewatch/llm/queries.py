"""Registered queries of the training-data operators, with SQL checks where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.llm import alignment, chat, extraction, langid, packing, pieces, quality, sharding, simhash, syncmers, trie, urls, warc
from tidewatch.llm.tables import store
from tidewatch.session import work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(name: str, sql: str | None = None) -> Callable:
    def add(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_register("op1_language_mixture")
def op1_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(langid.teachable(F.col("doc_id"))))
    found = langid.identify(docs, model)
    return found.select("doc_id", (~langid.teachable(F.col("doc_id"))).alias("held_out"), "lang_pred", "score",
                        F.size("mixture").alias("n_langs"))


@_register("op2_suffix_array_pieces")
def op2_suffix_array_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    rows = pieces.encode_documents(table(spark, sf_dir, "documents")).withColumn("n_ids", F.size("ids").cast("long"))
    decoded = pieces.decode_documents(rows).withColumn("decoded_sha256", F.sha2("decoded", 256))
    return decoded.select("doc_id", "n_ids", "ids_crc32", "decoded_sha256",
                          (F.col("decoded_sha256") == F.col("text_sha256")).alias("round_trip"))


_WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest,
  CASE WHEN strlen(body) >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN strlen(body) >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


@_register("op3_salvage_archives", _WARC_SQL)
def op3_salvage_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to archives and read back from them."""
    path = work_dir(spark, "archives")
    pages = table(spark, sf_dir, "pages")
    warc.write_archives(pages, path)
    found = warc.read_whole(spark, path, pages.count())
    return found.select(F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                        F.col("refers_to").cast("long").alias("refers_to"))


@_register("op4_simhash_anchors")
def op4_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("f")).alias("fingerprint"), "component_id")


SHARDS = 8


@_register("op5_jump_shards")
def op5_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A shard and a slot for every document under the law ``key``."""
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@_register("op6_closed_syncmers")
def op6_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text."""
    found = syncmers.compare_with_edits(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"),
        syncmers.as_string(F.col("fingerprint")).alias("fingerprint"),
        syncmers.as_string(F.col("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next")


_CONTROL = r"(<)(\\*)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|<SYS>>|</SYS>>)|(\[)(\\*)(INST\]|/INST\])"

_CHAT_SQL = rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, turn, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(turn, role)),
e AS (SELECT *, length(text) + len(regexp_extract_all(text, '{_CONTROL}')) AS text_chars FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + length(role) + 1 + text_chars + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@_register("op7_chat_machine", _CHAT_SQL)
def op7_chat_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that holds control strings, formatted and read back."""
    template = chat.Template()
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(own)
    read = chat.read_back(chat.format_segments(turns, template), template)
    return read.select(F.col("conv").cast("long").alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                       "formatted_chars")


@_register("op8_best_fit_packing")
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return packing.pack(table(spark, sf_dir, "documents"))


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_QUALITY_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
w AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d),
grams AS (SELECT r, i, word || ' ' || lead(word, 1) OVER p || ' ' || lead(word, 2) OVER p || ' ' || lead(word, 3) OVER p
            || ' ' || lead(word, 4) OVER p AS gram FROM w WINDOW p AS (PARTITION BY r ORDER BY i)),
hot AS (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM grams WHERE gram IS NOT NULL),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM hot, range(5) AS t(k) WHERE hot.n > 1 GROUP BY r),
lines AS (SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS dup
          FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(lines.dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
        coalesce(lines.n, 0) AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
        length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters
      FROM d LEFT JOIN covered USING (r) LEFT JOIN lines USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, list_filter([
    if(n_words < 10, 'too_few_words', ''), if(100 * n_repeat_words > 20 * n_words, 'repeated_windows', ''),
    if(word_chars < 2 * n_words, 'short_words', ''), if(word_chars > 20 * n_words, 'long_words', ''), if(10 * n_symbols > 3 * n_words, 'symbols', ''),
    if(n_lines >= 4 AND 10 * n_dup_lines > 4 * n_lines, 'repeated_lines', ''),
    if(n_letters >= 50 AND 10 * n_upper > 5 * n_letters, 'shouting', '')], lambda r: r <> '') AS why FROM m),
alone AS (SELECT *, CASE WHEN len(why) = 1 THEN why[1] END AS only_rule FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, len(why) = 0 AS kept, only_rule,
  CASE WHEN only_rule IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY only_rule) END AS n_only
FROM alone
"""


@_register("op9_rule_ledger", _QUALITY_SQL)
def op9_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements and verdicts of the default policy for every document, and what the rule that alone rejects it costs.

    The ledger is stored once; verdicts and ablations are read from its bits. ``n_only`` is the ablation's figure: how many
    documents of the corpus ``only_rule`` alone rejects.
    """
    stored = store(quality.ledger(table(spark, sf_dir, "documents")), "ledger").df
    policy = quality.DEFAULT_POLICY
    costs = quality.ablations(stored, {policy: quality.POLICIES[policy]}).select(F.col("rule").alias("only_rule"), "n_only")
    rows = stored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         (~quality.kept(F.col("failed"), "base")).alias("base_failed"),
                         quality.kept(F.col("failed")).alias("kept"), quality.only_rule(F.col("failed")).alias("only_rule"))
    # a row per rule, so the table is as small as the policy
    return rows.join(F.broadcast(costs), "only_rule", "left").withColumn("n_only", F.coalesce("n_only", F.lit(0).cast("long")))


URL_RULES = (
    urls.Rule("allow", "org", "/"), urls.Rule("block", "example.org", "/es/"), urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"), urls.Rule("block", "com", "/de/"),
)

_URL_SQL = r"""
WITH u AS (SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM pages),
fits AS (SELECT *, ends_with('.' || host, '.org') AND starts_with(path, '/') AS org,
    ends_with('.' || host, '.example.org') AND starts_with(path, '/es/') AS es,
    ends_with('.' || host, '.example.org') AND starts_with(path, '/en/1') AS en,
    ends_with('.' || host, '.com') AND starts_with(path, '/fr/') AS fr,
    ends_with('.' || host, '.com') AND starts_with(path, '/de/') AS de FROM u)
SELECT page_id, host, path,
    CASE WHEN en THEN 'example.org/en/1' WHEN es THEN 'example.org/es/' WHEN fr THEN 'com/fr/' WHEN de THEN 'com/de/'
         WHEN org THEN 'org/' END AS rule,
    CASE WHEN en OR es OR de OR (host = '' AND NOT (org OR fr)) THEN 'block' ELSE 'allow' END AS verdict
FROM fits
"""


@_register("op10_glob_automaton", _URL_SQL)
def op10_glob_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the longest fitting rule for every page's URL."""
    return urls.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@_register("op11_spilled_alignment")
def op11_spilled_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's alignment between two public tokenizers, its links weighed by corpus-wide counts."""
    return alignment.align_documents(table(spark, sf_dir, "documents")).documents


@_register("op12_prefix_trie")
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of the conversations, rebuilt with shared openings."""
    return trie.prefix_trie(trie.share_openings(trie.turn_digests(table(spark, sf_dir, "conversations"))))


_MAIN_TEXT_SQL = r"""
WITH inside AS (SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '<[^>]*>', ' ', 'g') AS body FROM pages),
decoded AS (SELECT page_id, url, replace(regexp_replace(replace(replace(replace(replace(body, '&lt;', '<'), '&gt;', '>'), '&copy;', '©'),
    '&middot;', '·'), '&quot;?', '"', 'g'), '&amp;', chr(1)) AS body FROM inside),
plain AS (SELECT page_id, url, trim(regexp_replace(replace(regexp_replace(body, '&amp', '&', 'g'), chr(1), '&'), '[\s]+', ' ', 'g')) AS text FROM decoded)
SELECT page_id, url, text, length(text) AS n_chars FROM plain
"""


@_register("op13_host_suffixes", _MAIN_TEXT_SQL)
def op13_host_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extraction.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
