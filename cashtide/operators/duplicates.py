"""Duplicate payments: within an account the first occurrence of a payment id wins."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashtide import schemas as S
from cashtide.functions.money import to_money
from cashtide.sources.workspace import materialize

PAYMENT_KEY = [*S.ACCOUNT_KEY, "payment_id"]


def repeated_ids(payments: DataFrame, order: list[str] = S.PAYMENT_ORDER) -> DataFrame:
    """Ids that occur more than once, with the position of the first: (key, ``_first``), stored.

    Occurrences are counted in a hash aggregate that combines map-side, so only ids are shuffled and
    an id with very many copies is one row per task.  Few ids repeat: the stored table is then small
    enough for the planner to broadcast, and payments are never shuffled or sorted.  A large table
    leads to a shuffled join, where adaptive execution splits hot ids.
    """
    counts = payments.groupBy(*PAYMENT_KEY).agg(F.count(F.lit(1)).alias("_copies"))
    several = materialize(counts.where("_copies > 1").drop("_copies"), "repeated-ids")
    candidates = payments.select(*PAYMENT_KEY, *order).join(several, PAYMENT_KEY, "left_semi")
    firsts = candidates.groupBy(*PAYMENT_KEY).agg(F.min(F.struct(*order)).alias("_first"))
    return materialize(firsts, "first-positions")


def first_occurrences(
    payments: DataFrame, order: list[str] = S.PAYMENT_ORDER, repeated: DataFrame | None = None
) -> DataFrame:
    """Payments without later copies.  ``order`` must be total.

    ``payments`` is read more than once: pass a stored table when it is costly to compute.
    """
    repeated = repeated_ids(payments, order) if repeated is None else repeated
    is_first = F.col("_first").isNull() | (F.struct(*order) == F.col("_first"))
    return payments.join(repeated, PAYMENT_KEY, "left").where(is_first).select(*payments.columns)


def later_copies(
    payments: DataFrame, order: list[str] = S.PAYMENT_ORDER, repeated: DataFrame | None = None
) -> DataFrame:
    """The copies that ``first_occurrences`` leaves out."""
    repeated = repeated_ids(payments, order) if repeated is None else repeated
    copies = payments.join(repeated, PAYMENT_KEY).where(F.struct(*order) > F.col("_first"))
    return copies.select(*payments.columns)


def duplicate_letters(copies: DataFrame, detected_at: Column | None = None) -> DataFrame:
    """Dead-letter rows for duplicate payments."""
    detected_at = F.current_timestamp() if detected_at is None else detected_at
    return copies.select(
        "payment_id",
        *S.ACCOUNT_KEY,
        to_money(F.col("amount_cents")).alias("amount"),
        "direction",
        F.concat(
            F.lit("payment_id was taken before for "), F.concat_ws(":", *S.ACCOUNT_KEY)
        ).alias("error"),
        F.lit(S.STAGE_DUPLICATE).alias("stage"),
        detected_at.alias("detected_at"),
    )
