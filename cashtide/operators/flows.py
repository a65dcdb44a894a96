"""Net flows in tumbling event-time windows (batch and stream)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashtide import schemas as S
from cashtide.functions.money import inbound, outbound, to_money, wide_sum


def flow_summary(payments: DataFrame, width: str = S.FLOW_WINDOW) -> DataFrame:
    """Inbound, outbound, net and count per (window, account).

    Map-side partial sums make hot accounts and hot windows cheap.  Pass de-duplicated payments to
    keep copies out; the flow of the raw feed counts them.
    """
    return (
        payments.groupBy(F.window("event_time", width).alias("w"), *S.ACCOUNT_KEY)
        .agg(
            wide_sum(inbound()).alias("inbound_cents"),
            wide_sum(outbound()).alias("outbound_cents"),
            F.count(F.lit(1)).alias("payment_count"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            *S.ACCOUNT_KEY,
            (F.col("inbound_cents") - F.col("outbound_cents")).cast(S.TOTAL_CENTS).alias("net_cents"),
            "inbound_cents",
            "outbound_cents",
            "payment_count",
        )
    )


def flow_by_currency(payments: DataFrame, width: str = S.FLOW_WINDOW) -> DataFrame:
    """Net flow per (window, currency), straight from payments: one shuffle, not two."""
    return (
        payments.groupBy(F.window("event_time", width).alias("w"), "currency")
        .agg(
            wide_sum(inbound()).alias("_in"),
            wide_sum(outbound()).alias("_out"),
            F.count(F.lit(1)).alias("payment_count"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            "currency",
            (F.col("_in") - F.col("_out")).cast(S.TOTAL_CENTS).alias("net_cents"),
            "payment_count",
        )
    )


def currency_totals(flows: DataFrame) -> DataFrame:
    """Net flow per (window, currency) from stored account flows."""
    return flows.groupBy("window_start", "currency").agg(
        F.sum("net_flow").alias("net_flow"), F.sum("payment_count").alias("payment_count")
    )


def flow_rows(flows: DataFrame) -> DataFrame:
    """Layout of the stored ``liquidity_flow_summary`` table."""
    return flows.select(
        "window_start",
        "window_end",
        *S.ACCOUNT_KEY,
        to_money(F.col("net_cents")).alias("net_flow"),
        to_money(F.col("inbound_cents")).alias("total_inbound"),
        to_money(F.col("outbound_cents")).alias("total_outbound"),
        "payment_count",
    )
