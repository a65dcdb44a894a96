"""Account positions: the ledger (one row per payment) and the current position (one per account)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashtide import schemas as S
from cashtide.functions.money import inbound, outbound, to_money, wide_sum
from cashtide.operators.blocks import MAX_BLOCK_ROWS, BlockScan, running
from cashtide.operators.merges import latest_per_key
from cashtide.sources.workspace import materialize


def _ledger_keys(reset: str | None) -> list[str]:
    return [*S.ACCOUNT_KEY, "business_date"] if reset == "day" else S.ACCOUNT_KEY


def position_ledger(
    payments: DataFrame,
    thresholds: DataFrame | None = None,
    reset: str | None = None,
    max_rows: int = MAX_BLOCK_ROWS,
    opening: DataFrame | None = None,
    time: str = "event_time",
    ranges: int | None = None,
) -> DataFrame:
    """Running balance, totals and count after each payment, in the order of (``time``, seq).

    With ``thresholds`` (their full history) each row also gets the bounds in force at that moment:
    threshold rows join the same ordered stream of their account, so the as-of lookup costs no
    join of its own and no broadcast.  Without a column ``time`` an update counts from its
    ``updated_at``.  ``reset='day'`` restarts totals every UTC day.  ``opening`` holds totals and
    ``bounds`` per account to start from.  ``ranges`` is described in ``blocks``.
    """
    keys = _ledger_keys(reset)
    columns = payments.columns
    work = payments
    latest = None
    if thresholds is not None:
        if reset:
            raise ValueError("thresholds carry over days: use them with lifetime totals")
        work, latest = _with_threshold_rows(payments, thresholds, time), {"bounds": F.col("_bounds")}
    if reset == "day":
        work = work.withColumn("business_date", F.to_date("event_time"))

    is_payment = F.col("_is_payment") == 1 if thresholds is not None else F.lit(True)
    zero = F.lit(0).cast("long")
    money_in = F.when(is_payment, inbound()).otherwise(zero)
    money_out = F.when(is_payment, outbound()).otherwise(zero)
    scan = BlockScan(
        sums={"inbound_cents": money_in, "outbound_cents": money_out},
        latest=latest,
        count="payment_count",
        counted=is_payment,
    )
    # A threshold published at the instant of a payment is in force for it.
    order = [time, *(["_is_payment"] if thresholds is not None else []), "seq"]
    rows = running(work, keys, order, scan, max_rows, opening, ranges)
    if thresholds is not None:
        rows = rows.where("_is_payment = 1")
    out = [
        *columns,
        *(["business_date"] if reset == "day" else []),
        (F.col("inbound_cents") - F.col("outbound_cents")).cast(S.TOTAL_CENTS).alias("balance_cents"),
        "inbound_cents",
        "outbound_cents",
        "payment_count",
    ]
    if thresholds is not None:
        out += ["bounds.warning_cents", "bounds.critical_cents"]
    return rows.select(*out)


def _with_threshold_rows(payments: DataFrame, thresholds: DataFrame, time: str) -> DataFrame:
    bounds = F.struct("warning_cents", "critical_cents")
    no_bounds = F.lit(None).cast("struct<warning_cents:bigint,critical_cents:bigint>")
    changes = thresholds.select(
        *S.ACCOUNT_KEY,
        F.col(time if time in thresholds.columns else "updated_at").alias(time),
        "seq",
        bounds.alias("_bounds"),
        F.lit(0).alias("_is_payment"),
    )
    return payments.withColumn("_bounds", no_bounds).withColumn("_is_payment", F.lit(1)).unionByName(
        changes, allowMissingColumns=True
    )


def current_positions(payments: DataFrame) -> DataFrame:
    """End state per account.

    Totals are a hash aggregate over fixed-width buffers.  The last payment id would turn it into
    a sort of all rows, so it is looked up after: only rows at an account's last instant take part.
    """
    totals = materialize(
        payments.groupBy(*S.ACCOUNT_KEY).agg(
            wide_sum(inbound()).alias("inbound_cents"),
            wide_sum(outbound()).alias("outbound_cents"),
            F.count(F.lit(1)).alias("payment_count"),
            F.max("event_time").alias("event_time"),
        ),
        "position-totals",
    )
    at_end = payments.select(*S.ACCOUNT_KEY, "event_time", "seq", "payment_id").join(
        totals.select(*S.ACCOUNT_KEY, "event_time"), [*S.ACCOUNT_KEY, "event_time"], "left_semi"
    )
    last = latest_per_key(at_end, S.ACCOUNT_KEY, ["seq"]).select(
        *S.ACCOUNT_KEY, F.col("payment_id").alias("last_payment_id")
    )
    return totals.join(last, S.ACCOUNT_KEY).select(
        *S.ACCOUNT_KEY,
        (F.col("inbound_cents") - F.col("outbound_cents")).cast(S.TOTAL_CENTS).alias("balance_cents"),
        "inbound_cents",
        "outbound_cents",
        "payment_count",
        "last_payment_id",
        "event_time",
    )


def position_rows(positions: DataFrame, last_updated=None) -> DataFrame:
    """Layout of the stored ``liquidity_positions`` table."""
    last_updated = F.current_timestamp() if last_updated is None else last_updated
    return positions.select(
        *S.ACCOUNT_KEY,
        to_money(F.col("balance_cents")).alias("available_balance"),
        to_money(F.col("inbound_cents")).alias("total_inbound"),
        to_money(F.col("outbound_cents")).alias("total_outbound"),
        F.col("payment_count").cast("long").alias("payment_count"),
        "last_payment_id",
        "event_time",
        last_updated.alias("last_updated"),
    )
