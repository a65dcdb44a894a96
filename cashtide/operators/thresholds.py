"""Threshold updates: validation, publication, latest value per account."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashtide import schemas as S
from cashtide.functions.keys import account_key, key_account, key_currency
from cashtide.functions.messages import STRICT_JSON, is_single_object, json_message
from cashtide.functions.money import to_cents, to_money
from cashtide.functions.times import iso_utc, parse_iso
from cashtide.operators.merges import latest_per_key, upsert
from cashtide.sources.workspace import materialize

_VERSION = ["updated_at", "seq"]


def decode_updates(df: DataFrame, *extra: str, raw: str = "raw") -> DataFrame:
    """Threshold messages (JSON text) to update rows with an ``error`` column (NULL if usable)."""
    p = df.withColumn("_t", F.from_json(raw, S.THRESHOLD_TEXT, STRICT_JSON))
    updates = p.select(
        "_t.currency",
        "_t.settlement_account",
        to_cents(F.col("_t.warning_threshold")).alias("warning_cents"),
        to_cents(F.col("_t.critical_threshold")).alias("critical_cents"),
        parse_iso(F.col("_t.updated_at")).alias("updated_at"),
        "_t.updated_by",
        (
            (F.col("_t.warning_threshold").isNotNull() & to_cents(F.col("_t.warning_threshold")).isNull())
            | (F.col("_t.critical_threshold").isNotNull() & to_cents(F.col("_t.critical_threshold")).isNull())
        ).alias("_bad_number"),
        (F.col(raw).isNotNull() & ~is_single_object(F.col(raw))).alias("_bad_text"),
        *extra,
    )
    checked = check_updates(updates, F.col("_bad_number"))
    error = F.coalesce("error", F.when(F.col("_bad_text"), F.lit("text behind the JSON object")))
    return checked.withColumn("error", error).drop("_bad_number", "_bad_text")


def decode_messages(messages: DataFrame, *extra: str) -> DataFrame:
    """Keyed threshold messages (key, raw, seq) to update rows with ``error`` and ``deleted``.

    A message without text deletes its key: both bounds are NULL from then on.
    """
    decoded = decode_updates(messages, "key", "raw", "seq", *extra)
    deleted = F.col("raw").isNull()
    named = account_key(key_currency(F.col("key")), key_account(F.col("key"))).isNotNull()
    accounts = {c: F.when(deleted, part(F.col("key"))).otherwise(F.col(c)) for c, part in zip(S.ACCOUNT_KEY, (key_currency, key_account))}
    error = F.when(deleted, F.when(~F.coalesce(named, F.lit(False)), F.lit("deletion without a key"))).otherwise(F.col("error"))
    return decoded.withColumns({**accounts, "error": error, "deleted": deleted}).drop("key", "raw")


def compacted(decoded: DataFrame) -> DataFrame:
    """What usable messages leave: the newest bounds of each account, deleted ones left out.

    A malformed message changes nothing, so it does not hide the one before it.
    """
    newest = accepted(decoded).groupBy(*S.ACCOUNT_KEY).agg(
        F.max_by(F.struct("warning_cents", "critical_cents", "deleted"), "seq").alias("_n")
    )
    return newest.where("NOT _n.deleted").select(*S.ACCOUNT_KEY, "_n.warning_cents", "_n.critical_cents")


def check_updates(updates: DataFrame, bad_number=None) -> DataFrame:
    """Add ``error``: why an update cannot be applied, NULL if it can."""
    bad_number = F.lit(False) if bad_number is None else bad_number
    error = (
        F.when(F.coalesce("currency", F.lit("")) == "", F.lit("missing currency"))
        .when(F.coalesce("settlement_account", F.lit("")) == "", F.lit("missing settlement_account"))
        .when(F.coalesce(bad_number, F.lit(False)), F.lit("threshold is not numeric"))
        .when(F.col("warning_cents") <= F.col("critical_cents"), F.lit("warning must be above critical"))
    )
    return updates.withColumn("error", error)


def normalized(updates: DataFrame) -> DataFrame:
    """Updates with upper-case currencies, as the desk's publisher sends them."""
    return updates.withColumn("currency", F.upper("currency"))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("error").isNull()).drop("error")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("error").isNotNull())


def latest_thresholds(updates: DataFrame) -> DataFrame:
    """The newest update of each account (what a compacted topic keeps).

    The newest times are a hash aggregate, so updates are not sorted; only those of that time are.
    """
    newest = updates.groupBy(*S.ACCOUNT_KEY).agg(F.max("updated_at").alias("_newest"))
    at_newest = updates.join(newest, S.ACCOUNT_KEY).where(F.col("updated_at").eqNullSafe(F.col("_newest")))
    return latest_per_key(at_newest.select(*updates.columns), S.ACCOUNT_KEY, _VERSION)


def publish_updates(updates: DataFrame, current: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Apply a batch of desk updates: (messages to publish, new thresholds table, rejected).

    Currencies are upper-cased.  Every accepted update is a message; the table keeps the newest.
    """
    checked = check_updates(normalized(updates))
    good = accepted(checked)
    return update_messages(good), upsert(current, good, S.ACCOUNT_KEY, _VERSION), rejected(checked)


def update_messages(updates: DataFrame) -> DataFrame:
    """Updates as (topic, key, value)."""
    fields = [
        *S.ACCOUNT_KEY,
        to_money(F.col("warning_cents")).alias("warning_threshold"),
        to_money(F.col("critical_cents")).alias("critical_threshold"),
        "updated_by",
        iso_utc(F.col("updated_at")).alias("updated_at"),
    ]
    return updates.select(
        F.lit(S.THRESHOLD_TOPIC).alias("topic"),
        account_key(*[F.col(c) for c in S.ACCOUNT_KEY]).alias("key"),
        json_message(fields).alias("value"),
    )


def threshold_rows(updates: DataFrame) -> DataFrame:
    """Layout of the stored ``thresholds`` table."""
    return updates.select(
        *S.ACCOUNT_KEY,
        to_money(F.col("warning_cents")).alias("warning_threshold"),
        to_money(F.col("critical_cents")).alias("critical_threshold"),
        "updated_at",
        "updated_by",
    )


def with_latest_bounds(rows: DataFrame, latest: DataFrame) -> DataFrame:
    """Left join of account rows to their newest bounds.

    ``latest`` has one row per account.  It is stored first, so the planner sees its true size: it
    broadcasts a small one, and otherwise joins by shuffle with hot accounts split.
    """
    bounds = materialize(latest.select(*S.ACCOUNT_KEY, "warning_cents", "critical_cents"), "latest-bounds")
    return rows.join(bounds, S.ACCOUNT_KEY, "left")
