"""Pending payments: scheduled refresh and the desk's queue."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashtide import schemas as S
from cashtide.operators.merges import insert_ignore


def expire(current: DataFrame, as_of: datetime) -> DataFrame:
    """PENDING rows past their due time become SETTLED."""
    return current.withColumn("status", F.when(_past_due(as_of), "SETTLED").otherwise(F.col("status")))


def purge(current: DataFrame, as_of: datetime) -> DataFrame:
    """Drop closed rows created more than 24 hours ago."""
    return current.where(~_purgeable(as_of))


def _past_due(as_of: datetime) -> Column:
    return F.coalesce(
        (F.col("status") == "PENDING") & (F.col("expected_settlement_time") < F.lit(as_of)), F.lit(False)
    )


def _purgeable(as_of: datetime) -> Column:
    old = F.col("created_at") < F.lit(as_of) - F.expr("INTERVAL 24 HOURS")
    return F.coalesce(F.col("status").isin(S.CLOSED_STATUSES) & old, F.lit(False))


def refresh_pending(
    current: DataFrame, incoming: DataFrame, as_of: datetime, order: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Expire, insert new ids, purge: (new snapshot, one-row run summary).

    Expiry comes first, so a row inserted already past due stays PENDING until the next run.
    One shuffle on payment_id does insert-ignore for both sides.
    """
    columns = current.columns
    expired = current.withColumn("_expired", _past_due(as_of))
    expired = expired.withColumn("status", F.when(F.col("_expired"), "SETTLED").otherwise(F.col("status")))
    allowed = F.col("direction").isin(S.DIRECTIONS) & F.col("status").isin(S.PENDING_STATUSES)
    loadable = incoming.withColumn("created_at", F.lit(as_of).cast("timestamp")).where(allowed)
    loadable = loadable.withColumn("_expired", F.lit(False))
    merged = insert_ignore(expired, loadable, ["payment_id"], order or ["created_at"], inserted="_inserted")
    merged = merged.withColumn("_purged", _purgeable(as_of))
    snapshot = merged.where(~F.col("_purged")).select(*columns)

    zero = F.lit(0).cast("long")
    counts = merged.agg(
        F.count_if("_inserted").alias("inserted"),
        F.count_if("_expired").alias("expired"),
        F.count_if("_purged").alias("deleted"),
    ).withColumn("generated", zero)
    offered = incoming.agg(F.count(F.lit(1)).alias("generated")).select(
        zero.alias("inserted"), zero.alias("expired"), zero.alias("deleted"), "generated"
    )
    summary = counts.unionByName(offered).agg(
        *[F.sum(c).alias(c) for c in ("generated", "inserted", "expired", "deleted")]
    )
    return snapshot, summary


def due_soon(pending: DataFrame, as_of: datetime, hours: int = 2) -> DataFrame:
    """PENDING rows due in [as_of, as_of + hours], both ends included."""
    start = F.lit(as_of)
    end = start + F.make_interval(hours=F.lit(hours))
    return pending.where((F.col("status") == "PENDING") & F.col("expected_settlement_time").between(start, end))


def pending_queue(pending: DataFrame, as_of: datetime, rows: int = 50) -> DataFrame:
    """The next due rows, earliest first (a top-k report)."""
    return due_soon(pending, as_of).orderBy("expected_settlement_time", "payment_id").limit(rows)


def largest_outbound(pending: DataFrame, as_of: datetime, rows: int = 10) -> DataFrame:
    """The largest DEBITs due in the next two hours (a top-k report)."""
    outbound = due_soon(pending, as_of).where(F.col("direction") == "DEBIT")
    return outbound.orderBy(F.desc("amount"), "payment_id").limit(rows)
