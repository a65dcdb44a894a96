"""Which payment ids came before: native keyed state, one small entry per account and id.

The ids of a stream are counted by a streaming aggregation, so its state (RocksDB) is spread over all
tasks by the hash of account and id, whatever share of the rows one account has; look-ups stay in the JVM and
no Python code runs per id or per account.  The stream carries the rows and, beside them, the ids that
occurred more than once so far, with their count.  A batch then knows of each of these ids how often it
occurred before: the count less the copies in the batch.

Without a time limit ids are kept for ever: a copy is refused however late it comes.  With ``ttl`` a copy
is refused if its id was seen less than ``ttl`` before, by arrival.  Arrivals are dealt to slots as long as
the limit.  A sighting counts in its own slot, where every later one is near enough, and is entered in the
next slot with the moment until which it counts there.  State of a slot is dropped by the watermark, one
slot later, so what is kept is bounded by the ids of two slots; the decision itself depends on arrival times
only, so it is the same however the input is cut into batches.  A row that arrives out of order by more
than ``ORDER_DELAY`` after its slot has been dropped is taken as new.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashtide import schemas as S
from cashtide.operators.duplicates import PAYMENT_KEY
from cashtide.sources.workspace import materialize

THRESHOLD_KIND, PAYMENT_KIND, SIGHTING_KIND = 0, 1, 2
ORDER_DELAY = 60  # seconds
ID = [*PAYMENT_KEY, "slot"]


def _slot(at: Column, ttl: int | None) -> Column:
    if ttl is None:
        return F.lit(0).cast("long")
    return F.floor(F.unix_micros(at) / F.lit(ttl * 1_000_000)).cast("long")


def _sightings(payments: DataFrame, ttl: int | None) -> DataFrame:
    """Ids with an earlier sighting that counts: their count in the slot, and ``until`` from the slot before."""
    if ttl is None:
        counted = payments.groupBy(*PAYMENT_KEY).agg(F.count(F.lit(1)).alias("sightings"))
        found = counted.select(*PAYMENT_KEY, _slot(F.lit(None), None).alias("slot"), "sightings", F.lit(None).cast("timestamp").alias("until"))
        return found.where("sightings > 1")
    later = F.col("arrived") + F.make_interval(secs=F.lit(ttl))
    entries = F.array(F.struct(F.col("arrived").alias("at"), F.lit(1).alias("own")), F.struct(later.alias("at"), F.lit(0).alias("own")))
    entered = payments.select(*PAYMENT_KEY, F.explode(entries).alias("entry")).select(*PAYMENT_KEY, "entry.*")
    # The newest entry is one limit ahead of the newest arrival.
    kept = entered.withWatermark("at", f"{ttl + ORDER_DELAY} seconds")
    counted = kept.groupBy(*PAYMENT_KEY, F.window("at", f"{ttl} seconds").alias("w")).agg(
        F.sum("own").alias("sightings"), F.max(F.when(F.col("own") == 0, F.col("at"))).alias("until")
    )
    found = counted.select(*PAYMENT_KEY, _slot(F.col("w.start"), ttl).alias("slot"), "sightings", "until")
    return found.where("sightings > 1 OR (sightings > 0 AND until IS NOT NULL)")


def with_sightings(payments: DataFrame, ttl: int | None = None) -> DataFrame:
    """A stream of payments and the sightings of their ids (``kind`` says which), in update mode."""
    # New names for all columns: else the union keeps those of the source on one side only, and the plans of
    # ``payments`` on its two sides are not the same shuffle.
    named = [F.col(name).alias(name) for name in payments.columns]
    rows = payments.select(*named, F.lit(PAYMENT_KIND).alias("kind"), _slot(F.col("arrived"), ttl).alias("slot"))
    sightings = _sightings(payments, ttl).withColumn("kind", F.lit(SIGHTING_KIND))
    return rows.unionByName(sightings, allowMissingColumns=True)


def marked(batch: DataFrame) -> DataFrame:
    """The payments of a stored batch with ``is_copy``.

    Of an id that is new in the batch the first in (arrived, seq) is no copy.  Only ids with several
    sightings are counted (map-side, so a very frequent id is one row a task) and stored; the join with
    them carries no hint.
    """
    sightings = batch.where(F.col("kind") == SIGHTING_KIND).select(*ID, "sightings", "until")
    payments = batch.where(F.col("kind") == PAYMENT_KIND).drop("kind", "sightings", "until")
    here = payments.join(sightings, ID, "left_semi").groupBy(*ID).agg(
        F.count(F.lit(1)).alias("_here"), F.min(F.struct("arrived", "seq")).alias("_first")
    )
    facts = materialize(here.join(sightings, ID).withColumn("_known", F.col("sightings") > F.col("_here")).drop("sightings", "_here"), "sightings")
    is_new = ~F.col("_known") & (F.struct("arrived", "seq") == F.col("_first")) & (F.col("until").isNull() | (F.col("arrived") >= F.col("until")))
    joined = payments.join(facts, ID, "left")
    return joined.withColumn("is_copy", F.col("_known").isNotNull() & ~is_new).drop("_known", "_first", "until", "slot")


def live_ids(spark, checkpoint: str) -> DataFrame:
    """The ids that an engine's checkpoint holds, by the state data source: their key, slot and sightings."""
    state = spark.read.format("statestore").load(checkpoint)
    keys, values = ([f.name for f in state.schema[part].dataType.fields] for part in ("key", "value"))
    limited = len(keys) > len(PAYMENT_KEY)
    no_time = F.lit(None).cast("timestamp")
    return state.select(
        *[F.col(f"key.`{name}`").alias(wanted) for name, wanted in zip(keys, PAYMENT_KEY)],
        (F.col(f"key.`{keys[-1]}`.start") if limited else no_time).alias("slot_start"),
        F.col(f"value.`{values[0]}`").alias("sightings"),
        (F.col(f"value.`{values[1]}`") if limited else no_time).alias("until"),
        "partition_id",
    )
