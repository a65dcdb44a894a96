"""Payments, thresholds and pending rows derived from the given tables.

All rules are integer or CASE logic over the table's own columns, so the derived data grow with
the tables and SQL can state the same rules.  Works on batch and on streaming frames.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cashtide.functions.money import to_cents

# ---- fixed values of the derived data (the SQL side states the same) ---------------------
# Account, currency, and the seed bounds (warning, critical) divided by ten, in cents.
_ACCOUNTS = [
    ("RTGS-GBP-001", "GBP", 20_000_000_000, 5_000_000_000),
    ("CHAPS-GBP-001", "GBP", 5_000_000_000, 1_000_000_000),
    ("INTERNAL-GBP-001", "GBP", 500_000_000, 100_000_000),
    ("NOSTRO-USD-001", "USD", 10_000_000_000, 2_500_000_000),
    ("NOSTRO-USD-002", "USD", 2_500_000_000, 500_000_000),
    ("NOSTRO-EUR-001", "EUR", 7_500_000_000, 1_500_000_000),
    ("NOSTRO-EUR-002", "EUR", 2_000_000_000, 400_000_000),
]
# Rail, least amount and what a unit of the event's value adds to it, in cents.
_RAILS = [("RTGS", 1_000_000_000, 1_000_000), ("CHAPS", 100_000_000, 200_000), ("INTERNAL", 10_000_000, 100_000)]
# -------------------------------------------------------------------------------------------

# By the remainder that chooses the account or the rail.
_ACCOUNT_BY_REST, _CURRENCY_BY_REST, _WARNING_BY_REST, _CRITICAL_BY_REST = map(list, zip(*_ACCOUNTS))
_RAIL_BY_REST, _BASE_BY_REST, _FACTOR_BY_REST = map(list, zip(*_RAILS))

EVENTS_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)
ORDERS_SCHEMA = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str, schema: str) -> DataFrame:
    """The same file as a stream source."""
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def _pick(rest: Column, values: list) -> Column:
    literal = [F.lit(v).cast("long") if isinstance(v, int) else F.lit(v) for v in values]
    chain = F.when(rest == 0, literal[0])
    for i, value in enumerate(literal[1:], start=1):
        chain = chain.when(rest == i, value)
    return chain


def payments(events: DataFrame, *extra: str) -> DataFrame:
    """One payment per event; ``extra`` event columns pass through."""
    account, rail = F.col("user_id") % 7, F.col("event_id") % 3
    is_credit = F.col("event_type").isin("purchase", "click") | (
        (F.col("event_type") == "view") & (F.col("event_id") % 2 == 0)
    )
    cents = _pick(rail, _BASE_BY_REST) + F.round(F.col("value") * 100).cast("long") * _pick(rail, _FACTOR_BY_REST)
    return events.select(
        F.concat(F.lit("P"), F.col("event_id")).alias("payment_id"),
        _pick(account, _CURRENCY_BY_REST).alias("currency"),
        _pick(account, _ACCOUNT_BY_REST).alias("settlement_account"),
        cents.alias("amount_cents"),
        F.when(is_credit, "CREDIT").otherwise("DEBIT").alias("direction"),
        _pick(rail, _RAIL_BY_REST).alias("rail"),
        F.concat(F.lit("C"), F.col("user_id")).alias("counterparty"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_id").alias("seq"),
        *extra,
    )


def _amount_text(cents: Column) -> Column:
    units = F.floor(cents / 100).cast("long")
    return F.concat(units.cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))


def raw_feed(events: DataFrame) -> DataFrame:
    """Payment messages as JSON text (raw, seq, arrived) with injected faults and repeated rows.

    Every 97th event is sent twice: same id, event time and arrival 30 s later.
    """
    copies = F.sequence(F.lit(0), F.when(F.col("event_id") % 97 == 0, 1).otherwise(0))
    sent = events.withColumn("_copy", F.explode(copies))
    sent = sent.withColumn("ts", F.col("ts") + F.make_interval(secs=F.col("_copy") * 30))
    p = payments(sent, "_copy").withColumn("_fault", F.col("seq") % 100)

    def faulty(number: int, wrong: str | Column, right: Column) -> Column:
        return F.when(F.col("_fault") == number, wrong).otherwise(right)

    quoted_id = F.concat(F.lit('"'), "payment_id", F.lit('"'))
    amount = (
        F.when(F.col("_fault") == 2, "")
        .when(F.col("_fault") == 6, '"amount": "N/A", ')
        .when(F.col("_fault") == 7, '"amount": -5000, ')
        .when(F.col("_fault") == 8, '"amount": 900000000, ')
        .otherwise(F.concat(F.lit('"amount": '), _amount_text(F.col("amount_cents")), F.lit(", ")))
    )
    iso = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    message = F.concat(
        F.lit('{"payment_id": '), faulty(11, "null", quoted_id),
        F.lit(', "currency": "'), faulty(3, "CHF", F.col("currency")),
        F.lit('", "settlement_account": "'), "settlement_account",
        F.lit('", '), amount,
        F.lit('"direction": "'), faulty(4, "OUT", F.col("direction")),
        F.lit('", "rail": "'), faulty(5, "SWIFT", F.col("rail")),
        F.lit('", "counterparty": "'), "counterparty",
        F.lit('", "event_time": "'), faulty(9, "yesterday", iso),
        F.lit('"}'),
    )
    # A column of its own: written into every branch below, it makes code too long to be compiled.
    p = p.withColumn("_message", message)
    message = F.col("_message")
    raw = (
        F.when(F.col("_fault") == 1, F.concat(F.lit("not valid json {{ "), "payment_id"))
        .when(F.col("_fault") == 10, F.concat(F.lit('["'), "payment_id", F.lit('"]')))
        .when(F.col("_fault") == 12, F.concat(message, F.lit("x" * 600)))
        .when(F.col("_fault") == 13, F.concat(message, F.lit(" "), message))
        .when(F.col("_fault") == 14, F.concat(message, F.lit("}")))
        .otherwise(message)
    )
    return p.select(
        raw.alias("raw"), (F.col("seq") * 2 + F.col("_copy")).alias("seq"), F.col("event_time").alias("arrived")
    )


def threshold_updates(orders: DataFrame) -> DataFrame:
    """One desk update of an account's bounds per order, spread over January 2024.

    Of each 50 one has equal bounds and one no account (both refused), one lacks the warning bound
    and one has its currency in lower case.
    """
    account, kind = F.col("o_custkey") % 7, F.col("o_orderkey") % 50
    price = F.round(F.col("o_totalprice") * 100).cast("long")
    warning = _pick(account, _WARNING_BY_REST) + price * 10
    critical = _pick(account, _CRITICAL_BY_REST) + price * 2
    currency = _pick(account, _CURRENCY_BY_REST)
    since = F.unix_seconds(F.lit("2024-01-01 00:00:00+00:00").cast("timestamp"))
    return orders.select(
        F.when(kind == 3, F.lower(currency)).otherwise(currency).alias("currency"),
        F.when(kind == 1, F.lit(None)).otherwise(_pick(account, _ACCOUNT_BY_REST)).alias("settlement_account"),
        F.when(kind == 2, F.lit(None)).otherwise(F.when(kind == 0, critical).otherwise(warning)).alias("warning_cents"),
        critical.alias("critical_cents"),
        F.timestamp_seconds(since + (F.col("o_orderkey") * 7919) % 2_592_000).alias("updated_at"),
        F.concat(F.lit("desk-"), F.col("o_custkey") % 5).alias("updated_by"),
        F.col("o_orderkey").alias("seq"),
    )


def threshold_lines(orders: DataFrame) -> DataFrame:
    """The desk's updates as lines of a dumped topic (value, updated_at); see ``sources.payments.topic_lines``.

    Of each 40 one is cut short (no JSON) and one deletes its key.
    """
    updates = threshold_updates(orders).withColumn("currency", F.upper("currency"))
    kind = F.col("seq") % 40
    key = F.concat(F.col("currency"), F.lit(":"), F.coalesce("settlement_account", F.lit("")))
    bound = {name: F.col(f"{name}_cents") / F.lit(100.0) for name in ("warning", "critical")}
    message = F.to_json(F.struct(
        "currency", "settlement_account", bound["warning"].alias("warning_threshold"), bound["critical"].alias("critical_threshold"),
        "updated_by", F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated_at"),
    ))
    text = F.when(kind == 5, F.substring(message, 1, 30)).when(kind != 6, message)
    return updates.select(F.concat_ws("\t", F.col("seq").cast("string"), key, text).alias("value"), "updated_at")


def rail_messages(source: DataFrame, rail: str, name: Column, who: Column, cents: Column) -> DataFrame:
    """Messages of one rail from any table: JSON text with the account chosen by ``who``.

    Every 50th ``who`` has an empty account, so its message has no routing key.
    """
    account = F.when(who % 50 == 0, "").otherwise(_pick(who % 7, _ACCOUNT_BY_REST))
    raw = F.concat(
        F.lit('{"payment_id": "'), name,
        F.lit('", "currency": "'), _pick(who % 7, _CURRENCY_BY_REST),
        F.lit('", "settlement_account": "'), account,
        F.lit('", "amount": '), _amount_text(cents),
        F.lit(f', "rail": "{rail}"}}'),
    )
    return source.select(F.lit(f"payments.{rail.lower()}").alias("topic"), raw.alias("raw"))


def rail_feeds(events: DataFrame, orders: DataFrame, lineitem: DataFrame) -> list[DataFrame]:
    """Three rails, each from its own table."""
    order_cents, line_cents = to_cents(F.col("o_totalprice")), to_cents(F.col("l_extendedprice"))
    event_cents = to_cents(F.col("value"))
    line_name = F.concat(F.lit("L"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber"))
    return [
        rail_messages(events, "RTGS", F.concat(F.lit("P"), F.col("event_id")), F.col("user_id"), event_cents),
        rail_messages(orders, "CHAPS", F.concat(F.lit("O"), F.col("o_orderkey")), F.col("o_custkey"), order_cents),
        rail_messages(lineitem, "INTERNAL", line_name, F.col("l_suppkey"), line_cents),
    ]


def pending_current(events: DataFrame) -> DataFrame:
    """The stored queue: every event, in all four states."""
    rest = F.col("event_id") % 8
    status = F.when(rest < 5, "PENDING").when(rest == 5, "SETTLED").when(rest == 6, "CANCELLED").otherwise("FAILED")
    created = _pending_noon() - F.make_interval(hours=(F.col("event_id") % 48).cast("int"))
    return _pending(payments(events, status.alias("status"), created.alias("created_at")))


def pending_incoming(events: DataFrame, orders: DataFrame) -> DataFrame:
    """A new load: every order, and every event again, whose ids are queued already and must be ignored."""
    status, created = F.lit("PENDING").alias("status"), _pending_noon().alias("created_at")
    return _pending(payments(events, status, created)).unionByName(_pending(order_payments(orders).select("*", status, created)))


def order_payments(orders: DataFrame) -> DataFrame:
    """One payment per order, of the customer's account."""
    account = F.col("o_custkey") % 7
    return orders.select(
        F.concat(F.lit("O"), F.col("o_orderkey")).alias("payment_id"),
        _pick(account, _CURRENCY_BY_REST).alias("currency"),
        _pick(account, _ACCOUNT_BY_REST).alias("settlement_account"),
        to_cents(F.col("o_totalprice")).alias("amount_cents"),
        F.when(F.col("o_orderstatus") == "O", "CREDIT").otherwise("DEBIT").alias("direction"),
        _pick(F.col("o_orderkey") % 3, _RAIL_BY_REST).alias("rail"),
        F.concat(F.lit("C"), F.col("o_custkey")).alias("counterparty"),
        F.col("o_orderdate").cast("timestamp").alias("event_time"),
        F.col("o_orderkey").alias("seq"),
    )


def _pending_noon() -> Column:
    return F.lit("2024-01-15 12:00:00+00:00").cast("timestamp")


def _pending(p: DataFrame) -> DataFrame:
    due = _pending_noon() + F.make_interval(mins=((F.col("seq") * 7) % 360 - 120).cast("int"))
    return p.select(
        "payment_id",
        "currency",
        "settlement_account",
        (F.col("amount_cents") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(20,2)").alias("amount"),
        "direction",
        "rail",
        "counterparty",
        due.alias("expected_settlement_time"),
        "status",
        "created_at",
    )
