"""A training corpus from ``documents``: filter, deduplicate, decontaminate, redact and encode.

Every stage takes (spark, docs, sf_dir) and returns rows; ``run`` writes them as Parquet in the shared
folder and reads them back for the next stage, so a lost executor never replays an earlier stage.
"""

from pyspark.sql import DataFrame, SparkSession

from cashtide.llm import decontaminate, order_minhash, secrets, sentencepiece, toxicity
from cashtide.sources.workspace import materialize

MODEL = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is predicted toxic go."""
    return toxicity.without_toxic(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays, the one with the least id."""
    return order_minhash.without_near_duplicates(docs, by="words")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_leaks(docs, _table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are replaced by a mark, and n_chars follows."""
    return secrets.redacted(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of every text, behind the columns of the documents."""
    return sentencepiece.encode(docs, MODEL)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("secrets", redact_secrets),
    ("sentencepiece", encode),
]

# The label model, the alignment and the piece model cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs


QUERIES = {"pipeline": run}
