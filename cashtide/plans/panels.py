"""Treasury dashboard queries over the stored tables; ``as_of`` stands for now."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashtide import schemas as S
from cashtide.operators import feeds, pending
from cashtide.operators.alerts import severity
from cashtide.operators.flows import currency_totals


def _since(as_of: datetime, hours: int) -> Column:
    return F.lit(as_of) - F.make_interval(hours=F.lit(hours))


def position_gauge(positions: DataFrame) -> DataFrame:
    """Balance per account."""
    return positions.orderBy(*S.ACCOUNT_KEY).select(
        F.col("settlement_account").alias("metric"), F.col("available_balance").alias("value")
    )


def traffic_light(positions: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Balance per account with its own bounds' colour: red, orange or green."""
    bounds = thresholds.select(*S.ACCOUNT_KEY, "warning_threshold", "critical_threshold")
    level = severity(F.col("available_balance"), F.col("warning_threshold"), F.col("critical_threshold"))
    colour = F.when(level == "CRITICAL", "red").when(level == "WARNING", "orange").otherwise("green")
    return (
        positions.join(bounds, S.ACCOUNT_KEY, "left")
        .select(*S.ACCOUNT_KEY, "available_balance", "warning_threshold", "critical_threshold", colour.alias("colour"))
        .orderBy(*S.ACCOUNT_KEY)
    )


def recent_positions(positions: DataFrame, as_of: datetime, hours: int = 8) -> DataFrame:
    """Accounts updated in the last hours, by update time."""
    return (
        positions.where(F.col("last_updated") >= _since(as_of, hours))
        .select(
            F.col("last_updated").alias("time"),
            F.col("available_balance").alias("value"),
            F.col("settlement_account").alias("metric"),
        )
        .orderBy("time", "metric")
    )


def net_flows(flow_table: DataFrame, as_of: datetime, hours: int = 2) -> DataFrame:
    """Net flow per (window, currency) of the last hours."""
    recent = flow_table.where(F.col("window_start") >= _since(as_of, hours))
    return currency_totals(recent).orderBy("window_start", "currency")


def account_flows(flow_table: DataFrame, as_of: datetime, hours: int = 2) -> DataFrame:
    """Net flow rows of the last hours, one per account."""
    return (
        flow_table.where(F.col("window_start") >= _since(as_of, hours))
        .select(
            F.col("window_start").alias("time"),
            F.col("net_flow").alias("value"),
            F.col("currency").alias("metric"),
            "settlement_account",
        )
        .orderBy("time", "metric", "settlement_account")
    )


def pending_queue(table: DataFrame, as_of: datetime) -> DataFrame:
    return pending.pending_queue(table, as_of).select(
        "payment_id",
        "expected_settlement_time",
        *S.ACCOUNT_KEY,
        "amount",
        "direction",
        "rail",
        "counterparty",
    )


def feed_status(health: DataFrame, as_of: datetime, timeout_seconds: int = S.STALE_FEED_SECONDS) -> DataFrame:
    """0/1 per rail at ``as_of``: a feed that is dead by then shows as stale though no row arrived since."""
    return feeds.stale_flags(feeds.stale_at(health, F.lit(as_of), timeout_seconds)).orderBy("rail")


def threshold_list(thresholds: DataFrame) -> DataFrame:
    return thresholds.orderBy(*S.ACCOUNT_KEY)
