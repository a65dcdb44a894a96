"""Payment and threshold feeds, and the merged rail stream."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashtide import schemas as S
from cashtide.functions.keys import account_key
from cashtide.functions.times import parse_iso


def kafka_options(servers: str, topics: list[str], per_trigger: int | None = None) -> dict[str, str]:
    """Source options: first start reads from the earliest offset, later ones from the checkpoint.

    ``per_trigger`` bounds the records of a trigger; the keyed engine needs it where one account can
    bring more than a task holds.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def kafka_columns(records: DataFrame) -> DataFrame:
    """Kafka records as (topic, raw, seq, arrived).

    ``seq`` orders records within a partition of a topic; records of one account share a partition.
    """
    return records.select(
        "topic", F.col("value").cast("string").alias("raw"), F.col("offset").alias("seq"), F.col("timestamp").alias("arrived")
    )


def kafka_stream(spark: SparkSession, servers: str, topics: list[str], **kwargs) -> DataFrame:
    options = kafka_options(servers, topics, **kwargs)
    return kafka_columns(spark.readStream.format("kafka").options(**options).load())


def payment_stream(spark: SparkSession, servers: str) -> DataFrame:
    """The merged payments topic."""
    return kafka_stream(spark, servers, [S.PAYMENTS_TOPIC])


def rail_stream(spark: SparkSession, servers: str) -> DataFrame:
    """The three rail topics through one subscription."""
    return kafka_stream(spark, servers, S.RAIL_TOPICS)


def threshold_stream(spark: SparkSession, servers: str) -> DataFrame:
    """The threshold topic, always from its start: compacted, so small and complete."""
    return kafka_stream(spark, servers, [S.THRESHOLD_TOPIC])


def threshold_topic(spark: SparkSession, servers: str) -> DataFrame:
    """The threshold topic as a batch table."""
    options = kafka_options(servers, [S.THRESHOLD_TOPIC], per_trigger=None)
    return kafka_columns(spark.read.format("kafka").options(**options).load())


def text_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines files as a stream of (raw, seq, arrived).

    Lines of a file carry no offset: those of one file are taken in event-time order, ties by a
    hash of the text.
    """
    reader = spark.readStream.format("text")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    event_time = parse_iso(F.get_json_object("value", "$.event_time"))
    millis = F.coalesce(F.unix_millis(event_time), F.lit(0).cast("long"))
    return reader.load(folder).select(
        F.col("value").alias("raw"),
        (millis * F.lit(1 << 20).cast("long") + F.pmod(F.xxhash64("value"), F.lit(1 << 20))).alias("seq"),
        F.col("_metadata.file_modification_time").alias("arrived"),
    )


def topic_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines of a dumped topic, ``offset TAB key [TAB message]``, as (key, raw, seq).

    A line without a message is a deletion of its key; a line without an offset has a NULL ``seq``.
    """
    parts = F.split(value, "\t", 3)
    message = F.when(F.size(parts) > 2, F.element_at(parts, 3))
    return lines.select(
        F.when(F.size(parts) > 1, F.element_at(parts, 2)).alias("key"),
        message.alias("raw"),
        F.element_at(parts, 1).try_cast("long").alias("seq"),
    )


def topic_files(spark: SparkSession, folder: str, stream: bool = True, files_per_trigger: int | None = None) -> DataFrame:
    """Files of a dumped topic, as a stream or as a table; either can be read again from its start."""
    if not stream:
        return topic_lines(spark.read.text(folder))
    reader = spark.readStream.format("text")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return topic_lines(reader.load(folder))


def spread(feed: DataFrame) -> DataFrame:
    """Deal messages to all tasks before they are parsed, for feeds with fewer partitions than cores.

    Parsing is the costly step; by position the deal is even, whatever the messages hold.
    """
    return feed.repartition("seq")


def merge_rails(rails: list[DataFrame]) -> DataFrame:
    """Bag union of rail streams; no order between rails."""
    return reduce(lambda a, b: a.unionByName(b), rails)


def routed(messages: DataFrame, raw: str = "raw") -> DataFrame:
    """Messages with their routing key; NULL key when the text has no currency or account."""
    p = F.from_json(raw, "currency STRING, settlement_account STRING")
    keyed = messages.withColumn("_k", p)
    return keyed.select(
        *[c for c in messages.columns if c != raw],
        account_key(F.col("_k.currency"), F.col("_k.settlement_account")).alias("key"),
        F.col(raw).alias("value"),
    )
