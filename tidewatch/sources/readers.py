"""Batch and streaming readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidewatch.functions.scalar import computed_once
from tidewatch.schema import COUNTRY_DOC, RAW_MESSAGE

TEXT_SUFFIXES = (".txt", ".md")


def _one_json(text: Column) -> Column:
    """The variant of a text that is one JSON value and nothing else; null for any other."""
    inside = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    return F.when(F.size(inside) == 1, F.get(inside, 0))


def json_documents(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """JSON objects of files that hold one object, a list of objects, or an object per line; and a quarantine.

    Each file is read as text and its documents as variants, so that its form need
    not be known. Returns (``source_path``, ``place`` from 0, the columns of ``schema``) and (``source_path``, ``place``, ``payload``,
    ``reject_reason``) for whatever is no JSON or no object. A field that is missing or of another kind is null.
    Blank lines and files count for nothing.
    """
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("source_path"), F.col("value").alias("payload"), _one_json(F.col("value")).alias("_whole"))
    is_list = F.schema_of_variant("_whole").startswith("ARRAY")
    listed = files.filter(is_list).select("source_path", F.posexplode(F.try_variant_get("_whole", "$", "array<variant>")).alias("place", "_doc"))
    single = files.filter(F.col("_whole").isNotNull() & ~is_list).select("source_path", F.lit(0).alias("place"), F.col("_whole").alias("_doc"))
    lines = files.filter(F.col("_whole").isNull()).select("source_path", F.posexplode(F.split("payload", "\r?\n")).alias("place", "payload")).filter(
        F.trim("payload") != "").select("source_path", "place", _one_json(F.col("payload")).alias("_doc"), "payload")
    every = lines.unionByName(single, allowMissingColumns=True).unionByName(listed, allowMissingColumns=True)
    every = every.withColumn("_object", F.coalesce(F.schema_of_variant("_doc").startswith("OBJECT"), F.lit(False)))
    kinds = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    good = every.filter("_object").select(
        "source_path", "place", *[F.try_variant_get("_doc", f"$.{name}", kind).alias(name) for name, kind in kinds])
    reason = F.when(F.col("_doc").isNull(), "no JSON").otherwise("no object")
    bad = every.filter("NOT _object").select(
        "source_path", "place", F.coalesce("payload", F.to_json("_doc")).alias("payload"), reason.alias("reject_reason"))
    return good, bad


def country_documents(spark: SparkSession, path: str, code: str | None = None) -> DataFrame:
    """Landed country JSON in files of any of the forms of :func:`json_documents`; ``code`` picks one country."""
    docs = json_documents(spark, path, COUNTRY_DOC)[0].drop("source_path", "place")
    if code is None:
        return docs
    wanted = code.upper()
    return docs.filter((F.upper("cca2") == wanted) | (F.upper("cca3") == wanted))


def text_files(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Whole text files as documents, and a quarantine of unsupported file types.

    The quarantine lists file names only; refused files are never read.
    """
    def listing(pattern: str) -> DataFrame:
        return (
            spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
        )

    accepted = listing("*.{txt,TXT,md,MD}").text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("source_path"), F.col("value").alias("text")
    )
    names = listing("*").format("binaryFile").load(path).select(F.col("path").alias("source_path"))
    suffix = F.lower(F.regexp_extract("source_path", r"(\.[^./]+)$", 1))
    refused = names.filter(~suffix.isin(*TEXT_SUFFIXES)).select(
        "source_path", F.concat(F.lit("refused file type "), suffix).alias("reject_reason")
    )
    return accepted, refused


def report_lines(reports: DataFrame, text: str, *keys: str) -> DataFrame:
    """Split report texts into numbered lines, blank lines included."""
    return reports.select(*keys, F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"))


def parse_messages(payload: DataFrame, column: str = "value") -> DataFrame:
    """JSON messages to raw events; a payload that is no JSON object becomes an all-NULL row."""
    text = payload.select(F.col(column).cast("string").alias("payload"))
    return computed_once(text, m=F.from_json("payload", RAW_MESSAGE)).select(
        "m.source_type", "m.source_id", "m.raw_text",
        F.coalesce("m.metadata", F.create_map().cast("map<string,string>")).alias("metadata"),
        "payload",
    )


def message_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of JSON messages landed as text files, one message per line; a batch takes all that is there unless limited."""
    reader = spark.readStream if max_files is None else spark.readStream.option("maxFilesPerTrigger", max_files)
    return parse_messages(reader.text(path))


def message_topic(spark: SparkSession, servers: str, topic: str, max_messages: int | None = None, **options: str) -> DataFrame:
    """The same stream from a broker, from the earliest offset (needs the Kafka connector)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
    )
    if max_messages is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_messages)
    return parse_messages(reader.load())


def messages_of(df: DataFrame) -> DataFrame:
    """Render raw events as JSON message lines (column ``value``)."""
    return df.select(F.to_json(F.struct(*[f.name for f in RAW_MESSAGE])).alias("value"))

