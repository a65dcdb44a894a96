"""Scheduled batch jobs over the stored tables: pending refresh and threshold publication.

``run`` numbers the runs of a job; repeating a run starts from the same snapshot and replaces its own.
"""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from cashtide import schemas as S
from cashtide.operators import pending, thresholds
from cashtide.sources.tables import VersionedTable, read_batch, write_batch
from cashtide.streaming.jobs import Output


def refresh_pending(spark: SparkSession, incoming: DataFrame, as_of: datetime, output: Output, run: int) -> DataFrame:
    """Refresh the pending table from a load and store the run summary, which is returned."""
    table = VersionedTable(spark, output.table("pending_payments"), S.TABLES["pending_payments"])
    snapshot, summary = pending.refresh_pending(table.read(before=run), incoming, as_of)
    table.write(snapshot, run)
    write_batch(summary, output.table("pending_runs"), run)
    return read_batch(spark, output.table("pending_runs"), run, summary.schema)


def publish_thresholds(spark: SparkSession, updates: DataFrame, output: Output, run: int) -> DataFrame:
    """Publish desk updates to the topic and merge them into the table; returns the refused ones."""
    table = VersionedTable(spark, output.table("thresholds_state"), S.THRESHOLD)
    messages, merged, refused = thresholds.publish_updates(updates, table.read(before=run))
    output.publish(messages, "thresholds", run)
    table.write(merged, run)
    return refused
