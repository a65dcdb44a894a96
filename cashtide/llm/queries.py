"""The numbered operators over the given tables: name -> f(spark, sf_dir), and their SQL."""

from pyspark.sql import DataFrame, SparkSession

from cashtide.llm import (
    centroids,
    decontaminate,
    exact_dedup,
    filter_audit,
    fingerprints,
    order_minhash,
    secrets,
    sentencepiece,
    suffix_dedup,
    token_counts,
    toxicity,
    url_filter,
    warc,
)

QUERIES = {}
ORACLE = {
    "op2_warc": warc.ARCHIVED_SQL,
    "op11_exact_dedup": exact_dedup.DEDUPLICATED_SQL,
    "op12_filter_audit": filter_audit.AUDIT_SQL,
    "op13_centroids": centroids.CLUSTERED_SQL,
}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model)


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page in a WARC archive, as read back by byte ranges."""
    return warc.archived_pages(table(spark, sf_dir, "pages"))


@query
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on the address of every page."""
    return url_filter.judged(table(spark, sf_dir, "pages"))


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated strings of 400 bytes."""
    return suffix_dedup.removed(table(spark, sf_dir, "documents")).drop("kept")


@query
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.leaks(docs, table(spark, sf_dir, "benchmark"))


@query
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece.encode(docs, "piece_bpe_32k.model").drop("text")


@query
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fingerprint of every document and of its edited text, and how like they are."""
    return fingerprints.fingerprinted(table(spark, sf_dir, "documents"))


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.with_token_counts(docs, "byte_bpe_50k.json").drop("text")


@query
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secrets.secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near-duplicates of every document."""
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents"), by="words")


@query
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of equal texts of every document, and which of them stays."""
    return exact_dedup.deduplicated(table(spark, sf_dir, "documents"))


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in each of their orders, per source."""
    return filter_audit.interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every embedding."""
    return centroids.clustered(table(spark, sf_dir, "embeddings"))
