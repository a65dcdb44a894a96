"""Feed silence per account and liveness per rail."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cashtide import schemas as S
from cashtide.functions.money import wide_sum
from cashtide.functions.times import in_business_hours
from cashtide.operators.blocks import MAX_BLOCK_ROWS, BlockScan, running


def feed_gaps(
    payments: DataFrame,
    as_of: datetime,
    timeout_seconds: int = S.STALE_FEED_SECONDS,
    max_rows: int = MAX_BLOCK_ROWS,
) -> DataFrame:
    """Silences longer than the timeout after a payment, the one still open at ``as_of`` included.

    ``recovered_at`` is the payment that ended the silence, NULL while it lasts.
    """
    seen = payments.where(F.col("event_time") <= F.lit(as_of)).select(*S.ACCOUNT_KEY, "event_time", "seq")
    scan = BlockScan(sums={}, next_time="recovered_at")
    timeout = F.make_interval(secs=F.lit(timeout_seconds))
    detected_at = F.col("event_time") + timeout
    silent_until = F.coalesce("recovered_at", F.lit(as_of))
    return (
        running(seen, S.ACCOUNT_KEY, S.PAYMENT_ORDER, scan, max_rows)
        .where(silent_until > detected_at)
        .select(
            F.concat_ws(":", *S.ACCOUNT_KEY).alias("key"),
            F.col("event_time").alias("stale_since"),
            detected_at.alias("detected_at"),
            "recovered_at",
        )
    )


def rail_health(payments: DataFrame, as_of: datetime, timeout_seconds: int = S.STALE_FEED_SECONDS) -> DataFrame:
    """Last event, events in the last minute and stale flag, one row for every rail."""
    moment = F.lit(as_of)
    observed = (
        payments.where(F.col("event_time") <= moment)
        .groupBy("rail")
        .agg(
            F.max("event_time").alias("last_event_time"),
            F.count_if(F.col("event_time") > moment - F.expr("INTERVAL 1 MINUTE")).alias("event_count_1min"),
        )
    )
    rails = payments.sparkSession.createDataFrame([(r,) for r in S.RAILS], "rail STRING")
    return stale_at(rails.join(observed, "rail", "left"), moment, timeout_seconds)


def update_feed_health(
    table: DataFrame, observed: DataFrame, timeout_seconds: int = S.STALE_FEED_SECONDS
) -> DataFrame:
    """Merge new observations into the feed-health table, by rail; an event time never goes back."""
    merged = (
        table.unionByName(observed.select(*table.columns))
        .groupBy("rail")
        .agg(
            F.max("last_event_time").alias("last_event_time"),
            F.max_by("event_count_1min", "last_check_time").alias("event_count_1min"),
            F.max("last_check_time").alias("last_check_time"),
        )
    )
    return stale_at(merged, F.col("last_check_time"), timeout_seconds)


RECENT = T.StructType(
    [T.StructField("rail", T.StringType()), T.StructField("event_time", T.TimestampType()), T.StructField("events", T.LongType())]
)


def merge_recent(recent: DataFrame, payments: DataFrame, moment: datetime) -> DataFrame:
    """Events per rail and instant that count for ``moment`` or later: those of the minute before it, and newer ones."""
    new = payments.groupBy("rail", "event_time").agg(F.count(F.lit(1)).alias("events"))
    kept = F.col("event_time") > F.lit(moment) - F.expr("INTERVAL 1 MINUTE")
    return recent.unionByName(new).where(kept).groupBy("rail", "event_time").agg(F.sum("events").alias("events"))


def health_from(table: DataFrame, payments: DataFrame, earlier: DataFrame, recent: DataFrame, moment: datetime) -> DataFrame:
    """The feed-health table at ``moment``, as ``rail_health`` gives it for all payments so far.

    ``recent`` is what ``merge_recent`` keeps, ``earlier`` what it kept before these payments: events that were
    too new then may be the last ones now.  Every rail has a row; event times never go back, and those after
    ``moment`` do not count yet.
    """
    rails = payments.sparkSession.createDataFrame([(r,) for r in S.RAILS], "rail STRING")
    times = [part.select("rail", F.col(name).alias("last_event_time")) for part, name in ((table, "last_event_time"), (payments, "event_time"), (earlier, "event_time"))]
    last = times[0].unionByName(times[1]).unionByName(times[2]).where(F.col("last_event_time") <= F.lit(moment))
    last = last.groupBy("rail").agg(F.max("last_event_time").alias("last_event_time"))
    in_minute = recent.where(F.col("event_time") <= F.lit(moment))
    minute = in_minute.groupBy("rail").agg(F.sum("events").alias("event_count_1min"))
    return stale_at(rails.join(last, "rail", "left").join(minute, "rail", "left"), F.lit(moment))


def stale_at(health: DataFrame, moment: Column, timeout_seconds: int = S.STALE_FEED_SECONDS) -> DataFrame:
    """Feed-health rows with the stale columns judged at ``moment``."""
    is_stale = F.col("last_event_time").isNull() | (
        moment - F.make_interval(secs=F.lit(timeout_seconds)) > F.col("last_event_time")
    )
    return health.select(
        "rail",
        "last_event_time",
        moment.cast("timestamp").alias("last_check_time"),
        is_stale.alias("is_stale"),
        F.when(is_stale, F.col("last_event_time")).alias("stale_since"),
        F.coalesce("event_count_1min", F.lit(0).cast("long")).alias("event_count_1min"),
    )


def stale_flags(health: DataFrame) -> DataFrame:
    """0/1 per rail for the status panel."""
    return health.select("rail", F.when(F.col("is_stale"), 1).otherwise(0).alias("value"))


def volume_by_hours(payments: DataFrame) -> DataFrame:
    """Count and amount per rail, business hours against overnight."""
    return payments.groupBy("rail", in_business_hours(F.col("event_time")).alias("in_business_hours")).agg(
        F.count(F.lit(1)).alias("payment_count"), wide_sum(F.col("amount_cents")).alias("amount_cents")
    )
