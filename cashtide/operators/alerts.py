"""Threshold alerts: one per payment that leaves the balance below a bound."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashtide import schemas as S
from cashtide.functions.keys import account_key
from cashtide.functions.messages import json_message
from cashtide.functions.money import to_money
from cashtide.functions.times import iso_utc


def severity(balance: Column, warning: Column, critical: Column) -> Column:
    """CRITICAL below the critical bound, else WARNING below the warning bound, else NULL.

    Strictly below; a missing bound never alerts.
    """
    return F.when(balance < critical, "CRITICAL").when(balance < warning, "WARNING")


def alerts(ledger: DataFrame) -> DataFrame:
    """Alerts from ledger rows that carry ``warning_cents`` and ``critical_cents``."""
    level = severity(F.col("balance_cents"), F.col("warning_cents"), F.col("critical_cents"))
    bound = F.when(F.col("alert_type") == "CRITICAL", F.col("critical_cents")).otherwise(F.col("warning_cents"))
    return (
        ledger.withColumn("alert_type", level)
        .where(F.col("alert_type").isNotNull())
        .select(
            "alert_type",
            *S.ACCOUNT_KEY,
            "balance_cents",
            bound.alias("threshold_cents"),
            (bound - F.col("balance_cents")).cast(S.TOTAL_CENTS).alias("breach_cents"),
            "payment_id",
            F.col("event_time").alias("triggered_at"),
        )
    )


def alert_rows(found: DataFrame) -> DataFrame:
    """Layout of the stored ``alert_log`` table."""
    return found.select(
        "alert_type",
        *S.ACCOUNT_KEY,
        to_money(F.col("balance_cents")).alias("available_balance"),
        to_money(F.col("threshold_cents")).alias("threshold_value"),
        to_money(F.col("breach_cents")).alias("breach_amount"),
        "triggered_at",
        "payment_id",
    )


def alert_messages(rows: DataFrame) -> DataFrame:
    """Alert rows as (topic, key, value), routed by severity."""
    topic = F.when(F.col("alert_type") == "CRITICAL", S.CRITICAL_TOPIC).otherwise(S.WARNING_TOPIC)
    fields = [
        "alert_type",
        *S.ACCOUNT_KEY,
        "available_balance",
        "threshold_value",
        "breach_amount",
        "payment_id",
        F.unix_millis("triggered_at").alias("triggered_at_ts"),
        iso_utc(F.col("triggered_at")).alias("triggered_at"),
    ]
    return rows.select(
        topic.alias("topic"),
        account_key(*[F.col(c) for c in S.ACCOUNT_KEY]).alias("key"),
        json_message(fields, "alert").alias("value"),
    )
