"""Row types and fixed values shared by the batch and the streaming jobs.

Money is carried as whole cents (LONG per payment, DECIMAL for totals), so sums are exact
in any order.  Tables and messages hold DECIMAL(20,2).
"""

from pyspark.sql import types as T

MONEY = T.DecimalType(20, 2)
TOTAL_CENTS = T.DecimalType(28, 0)

ACCOUNT_KEY = ["currency", "settlement_account"]
PAYMENT_ORDER = ["event_time", "seq"]

# ---- fixed values: must equal those of the upstream payment feed -------------------------
REQUIRED_FIELDS = [
    "payment_id",
    "currency",
    "settlement_account",
    "amount",
    "direction",
    "rail",
    "event_time",
]
CURRENCIES = ["EUR", "GBP", "USD"]
DIRECTIONS = ["CREDIT", "DEBIT"]
RAILS = ["CHAPS", "INTERNAL", "RTGS"]
# Inclusive amount range per rail, in whole currency units.
AMOUNT_RANGES = {
    "RTGS": (10_000_000, 500_000_000),
    "CHAPS": (1_000_000, 100_000_000),
    "INTERNAL": (100_000, 50_000_000),
}
PENDING_STATUSES = ["PENDING", "SETTLED", "FAILED", "CANCELLED"]
CLOSED_STATUSES = ["SETTLED", "CANCELLED", "FAILED"]
STALE_FEED_SECONDS = 60
FLOW_WINDOW = "5 minutes"
WATERMARK_DELAY = "1 second"
BUSINESS_HOURS = ("07:00", "18:00")
RAW_KEPT_IN_DLQ = 500
RAIL_TOPICS = ["payments.rtgs", "payments.chaps", "payments.internal"]
PAYMENTS_TOPIC = "payments.all"
DLQ_TOPIC = "payments.dlq"
WARNING_TOPIC = "liquidity.warnings"
CRITICAL_TOPIC = "liquidity.critical"
THRESHOLD_TOPIC = "liquidity.thresholds"
FEED_HEALTH_TOPIC = "ops.feed.health"
# -------------------------------------------------------------------------------------------

STAGE_JSON = "json_parse"
STAGE_SCHEMA = "schema_validation"
STAGE_TIME = "timestamp_parse"
STAGE_DUPLICATE = "duplicate_detection"


_TEXT, _LONG, _TIME, _FLAG = T.StringType(), T.LongType(), T.TimestampType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Every JSON field is read as text first: the type checks are ours, not the JSON reader's.
PAYMENT_TEXT = _struct(
    payment_id=_TEXT,
    currency=_TEXT,
    settlement_account=_TEXT,
    amount=_TEXT,
    direction=_TEXT,
    rail=_TEXT,
    counterparty=_TEXT,
    event_time=_TEXT,
)
PAYMENT = _struct(
    payment_id=_TEXT,
    currency=_TEXT,
    settlement_account=_TEXT,
    amount_cents=_LONG,
    direction=_TEXT,
    rail=_TEXT,
    counterparty=_TEXT,
    event_time=_TIME,
    seq=_LONG,
)
THRESHOLD_TEXT = _struct(
    currency=_TEXT,
    settlement_account=_TEXT,
    warning_threshold=_TEXT,
    critical_threshold=_TEXT,
    updated_by=_TEXT,
    updated_at=_TEXT,
)
THRESHOLD = _struct(
    currency=_TEXT,
    settlement_account=_TEXT,
    warning_cents=_LONG,
    critical_cents=_LONG,
    updated_at=_TIME,
    updated_by=_TEXT,
    seq=_LONG,
)
DLQ = _struct(
    raw=_TEXT,
    payment_id=_TEXT,
    currency=_TEXT,
    settlement_account=_TEXT,
    amount=MONEY,
    direction=_TEXT,
    error=_TEXT,
    stage=_TEXT,
    detected_at=_TIME,
)

# Stored tables.
TABLES = {
    "liquidity_positions": _struct(
        currency=_TEXT,
        settlement_account=_TEXT,
        available_balance=MONEY,
        total_inbound=MONEY,
        total_outbound=MONEY,
        payment_count=_LONG,
        last_payment_id=_TEXT,
        event_time=_TIME,
        last_updated=_TIME,
    ),
    "liquidity_flow_summary": _struct(
        window_start=_TIME,
        window_end=_TIME,
        currency=_TEXT,
        settlement_account=_TEXT,
        net_flow=MONEY,
        total_inbound=MONEY,
        total_outbound=MONEY,
        payment_count=_LONG,
    ),
    "thresholds": _struct(
        currency=_TEXT,
        settlement_account=_TEXT,
        warning_threshold=MONEY,
        critical_threshold=MONEY,
        updated_at=_TIME,
        updated_by=_TEXT,
    ),
    "feed_health": _struct(
        rail=_TEXT,
        last_event_time=_TIME,
        last_check_time=_TIME,
        is_stale=_FLAG,
        stale_since=_TIME,
        event_count_1min=_LONG,
    ),
    "pending_payments": _struct(
        payment_id=_TEXT,
        currency=_TEXT,
        settlement_account=_TEXT,
        amount=MONEY,
        direction=_TEXT,
        rail=_TEXT,
        counterparty=_TEXT,
        expected_settlement_time=_TIME,
        status=_TEXT,
        created_at=_TIME,
    ),
    "alert_log": _struct(
        alert_type=_TEXT,
        currency=_TEXT,
        settlement_account=_TEXT,
        available_balance=MONEY,
        threshold_value=MONEY,
        breach_amount=MONEY,
        triggered_at=_TIME,
        payment_id=_TEXT,
    ),
}
TABLE_KEYS = {
    "liquidity_positions": ACCOUNT_KEY,
    "liquidity_flow_summary": ["window_start", *ACCOUNT_KEY],
    "thresholds": ACCOUNT_KEY,
    "feed_health": ["rail"],
    "pending_payments": ["payment_id"],
    "alert_log": ["payment_id", "alert_type", *ACCOUNT_KEY],
}

# One row per account or rail, so one task may read them from a database.
SMALL_TABLES = ["feed_health", "liquidity_positions", "thresholds"]
