"""Equi-join of rows with a table of unique keys, where one key may hold a great share of the rows.

Keys that hold more than a thousandth of all rows are fewer than a thousand, however large the input is:
these are broadcast, so their rows stay where they are.  All other keys are light, and meet their rows in
an ordinary shuffled join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 1_000


def looked_up(rows: DataFrame, table: DataFrame, keys: list[str], copies: str, total: int, most: int = HOT_KEYS) -> DataFrame:
    """Left join of ``rows`` with ``table`` on ``keys`` (not null).

    ``table`` has each key once and, in the column ``copies``, the number of rows that hold it; ``total``
    is the number of all rows.  Both inputs are read twice: pass stored tables.
    """
    least = max(1, total // most)
    values = [c for c in table.columns if c not in keys]
    hot = table.where(F.col(copies) > least).withColumn("_hot", F.lit(True))  # fewer than ``most`` rows
    marked = rows.join(F.broadcast(hot), keys, "left")
    of_hot = marked.where(F.col("_hot")).select(*rows.columns, *values)
    light = marked.where(F.col("_hot").isNull()).select(*rows.columns)
    of_light = light.join(table.where(F.col(copies) <= least), keys, "left").select(*rows.columns, *values)
    return of_hot.unionByName(of_light)
