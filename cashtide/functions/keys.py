"""The ``CCY:account`` routing key."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def account_key(currency: Column, account: Column) -> Column:
    """``CCY:account``; NULL when either part is missing or empty."""
    return F.when(
        (F.coalesce(currency, F.lit("")) != "") & (F.coalesce(account, F.lit("")) != ""),
        F.concat_ws(":", currency, account),
    )


def key_currency(key: Column) -> Column:
    """Part before the first colon."""
    return F.regexp_extract(key, "^([^:]*):(.*)$", 1)


def key_account(key: Column) -> Column:
    """Part after the first colon; it may hold further colons."""
    return F.regexp_extract(key, "^([^:]*):(.*)$", 2)
