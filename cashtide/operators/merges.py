"""Keyed merges of tables: upsert, insert-ignore, latest row per key.

Each is one shuffle on the key.  ``row_number() = 1`` is limited map-side by Spark, so hot keys
send one row per task.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_per_key(df: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """The row with the highest version of each key."""
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(v) for v in version])
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], version: list[str] | None = None) -> DataFrame:
    """Rows of ``batch`` replace rows of ``target`` with the same key.

    Within the batch the highest ``version`` wins.  Without versions batch keys must be unique.
    """
    tagged = target.withColumn("_from_batch", F.lit(0)).unionByName(
        batch.withColumn("_from_batch", F.lit(1)), allowMissingColumns=True
    )
    merged = latest_per_key(tagged, keys, ["_from_batch", *(version or [])])
    return merged.select(*target.columns)


def insert_ignore(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str],
    order: list[str | Column] | None = None,
    inserted: str | None = None,
) -> DataFrame:
    """Add rows of ``batch`` whose key is not in ``target``; in the batch the first in ``order`` wins.

    Rows already in the target all stay.  ``inserted`` names an optional flag column.
    """
    flag = inserted or "_inserted"
    tagged = target.withColumn(flag, F.lit(False)).unionByName(
        batch.withColumn(flag, F.lit(True)), allowMissingColumns=True
    )
    present_first = Window.partitionBy(*keys).orderBy(flag, *(order or keys))
    merged = tagged.withColumn("_rank", F.row_number().over(present_first)).where("_rank = 1").drop("_rank")
    return merged if inserted else merged.drop(flag)


def new_rows(batch: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``batch`` with keys not in ``target``, one per key (for append-only tables)."""
    return batch.dropDuplicates(keys).join(target.select(*keys), keys, "left_anti")
