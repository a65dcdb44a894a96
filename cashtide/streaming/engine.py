"""The account engine: ids in keyed state, balances by blocks, bounds and totals in small tables.

One streaming query takes payments and threshold changes.  Its only row-level state are payment ids
(``identity``), spread over all tasks.  A micro-batch is stored once; its new payments get their running
balances by a prefix over blocks of each account (``operators.blocks``), so an account that brings nearly
all rows still keeps all tasks busy.  What is kept per account, totals and the bounds in force, is one row
in a table that is read as of the batch before, so a replayed batch repeats exactly.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cashtide import schemas as S
from cashtide.functions.keys import account_key
from cashtide.functions.money import to_money
from cashtide.operators import duplicates, quality, thresholds
from cashtide.operators.merges import latest_per_key
from cashtide.operators.positions import position_ledger
from cashtide.sources.tables import VersionedTable, read_batch, write_batch
from cashtide.sources.workspace import materialize, scratch
from cashtide.streaming import identity, jobs
from cashtide.streaming.identity import PAYMENT_KIND, THRESHOLD_KIND
from cashtide.streaming.jobs import Output, configure, start, write_letters, write_positions

ARRIVAL_ORDER = ["arrived", "seq"]
PAYMENT_COLUMNS = [*S.ACCOUNT_KEY, "arrived", "seq", "payment_id", "amount_cents", "direction", "event_time"]
_BOUNDS = T.StructType([T.StructField("warning_cents", T.LongType()), T.StructField("critical_cents", T.LongType())])
STATE = T.StructType(
    [T.StructField(name, T.StringType()) for name in S.ACCOUNT_KEY]
    + [
        T.StructField("inbound_cents", S.TOTAL_CENTS),
        T.StructField("outbound_cents", S.TOTAL_CENTS),
        T.StructField("payment_count", T.LongType()),
        T.StructField("bounds", _BOUNDS),
    ]
)


APPLIED = T.StructType([T.StructField("key", T.StringType()), T.StructField("warning", S.MONEY), T.StructField("critical", S.MONEY)])


def keyed_payments(checked: DataFrame) -> DataFrame:
    """Accepted payments with the account key, dealt by all their columns.

    Rows and ids read this stream.  None of its columns can be left out for one of them, so they share
    one shuffle, and messages are parsed once a batch.
    """
    payments = quality.valid_payments(checked, "seq", "arrived").select(*PAYMENT_COLUMNS)
    return payments.repartition(*PAYMENT_COLUMNS)


def keyed_changes(updates: DataFrame) -> DataFrame:
    """Accepted threshold changes with the account key."""
    return thresholds.accepted(updates).select(
        *S.ACCOUNT_KEY, "arrived", "seq", "warning_cents", "critical_cents", F.lit(THRESHOLD_KIND).alias("kind")
    )


def engine_input(checked: DataFrame, updates: DataFrame | None, ttl: int | None = None) -> DataFrame:
    """Payments, the sightings of their ids and threshold changes as one stream, in update mode."""
    rows = identity.with_sightings(keyed_payments(checked), ttl)
    if updates is None:
        no_bound = F.lit(None).cast("long")
        return rows.withColumns({"warning_cents": no_bound, "critical_cents": no_bound})
    return rows.unionByName(keyed_changes(updates), allowMissingColumns=True)


def start_engine(
    checked: DataFrame,
    updates: DataFrame | None,
    output: Output,
    available_now: bool = False,
    id_ttl_seconds: int | None = None,
    ranges: int | None = None,
    opening_bounds: DataFrame | None = None,
) -> StreamingQuery:
    """Positions, ledger, alerts, duplicates and applied thresholds from one stateful query.

    ``checked`` comes from ``quality.check`` over (raw, seq, arrived), ``updates`` from
    ``thresholds.decode_updates`` or ``check_updates`` with seq and arrived.  ``opening_bounds`` (one row per
    account) are in force before the first payment of a new engine; a restarted one has its own.  A batch
    is cut in ``ranges`` for the running balances; by default as many as a shuffle has partitions.
    """
    spark = checked.sparkSession
    configure(spark)
    if opening_bounds is not None:
        open_with(opening_bounds, output)
    rows = jobs.timed(engine_input(checked, updates, id_ttl_seconds))
    writer = rows.writeStream.outputMode("update").foreachBatch(
        lambda batch, batch_id: process_batch(batch, batch_id, output, ranges)
    )
    return start(writer, "engine", output, available_now)


def account_state(spark: SparkSession, output: Output) -> VersionedTable:
    return VersionedTable(spark, output.table("account_state"), STATE)


def open_with(bounds: DataFrame, output: Output) -> None:
    """Bounds in force before the first batch, as a version before it; nothing if the engine ran before."""
    state = account_state(bounds.sparkSession, output)
    if state.versions():
        return
    values = {"inbound_cents": None, "outbound_cents": None, "payment_count": None, "bounds": F.struct("warning_cents", "critical_cents")}
    rows = bounds.select(*S.ACCOUNT_KEY, *[(F.lit(v) if v is None else v).alias(k) for k, v in values.items()])
    state.write(rows, -1)
    write_batch(applied_rows(bounds), output.table("thresholds_applied"), -1)


def process_batch(batch: DataFrame, batch_id: int, output: Output, ranges: int | None = None) -> None:
    spark = batch.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    with scratch(spark):
        # Stored once: everything below reads it, and no lost executor asks the state store again.
        stored = materialize(batch, "batch")
        kinds = {r["kind"] for r in stored.select("kind").distinct().collect()}  # three at most
        if kinds:
            _process(stored, kinds, batch_id, output, ranges)


def _process(batch: DataFrame, kinds: set[int], batch_id: int, output: Output, ranges: int) -> None:
    state = account_state(batch.sparkSession, output)
    opening = state.read(before=batch_id)
    changes = batch.where(F.col("kind") == THRESHOLD_KIND).select(*S.ACCOUNT_KEY, "warning_cents", "critical_cents", *ARRIVAL_ORDER)
    payments = identity.marked(batch).drop("warning_cents", "critical_cents")
    if identity.SIGHTING_KIND in kinds:
        letters = duplicates.duplicate_letters(payments.where("is_copy"))
        write_letters(quality.dead_letters(letters), "payments_dlq_duplicates", batch_id, output)
    if THRESHOLD_KIND in kinds:
        write_batch(applied_rows(changes), output.table("thresholds_applied"), batch_id)
    newest = None
    if PAYMENT_KIND in kinds:
        fresh = payments.where("NOT is_copy").drop("is_copy")
        rows = position_ledger(fresh, changes, opening=opening, time="arrived", ranges=ranges)
        write_batch(rows, output.table("position_ledger"), batch_id, "event_time")
        ledger = read_batch(batch.sparkSession, output.table("position_ledger"), batch_id, rows.schema)
        newest = materialize(latest_per_key(ledger, S.ACCOUNT_KEY, ["payment_count"]), "newest")
        write_positions(ledger, newest, batch_id, output)
    state.write(_next_state(opening, newest, changes), batch_id)


def applied_rows(changes: DataFrame) -> DataFrame:
    """The record that a threshold change was applied; both bounds are NULL where they were deleted."""
    key = account_key(*[F.col(c) for c in S.ACCOUNT_KEY]).alias("key")
    return changes.select(key, to_money(F.col("warning_cents")).alias("warning"), to_money(F.col("critical_cents")).alias("critical"))


def _next_state(opening: DataFrame, newest: DataFrame | None, changes: DataFrame) -> DataFrame:
    """One row per account: totals after its last payment, bounds after its last change."""
    totals = ["inbound_cents", "outbound_cents", "payment_count"]
    bounds = latest_per_key(changes, S.ACCOUNT_KEY, ARRIVAL_ORDER).select(
        *S.ACCOUNT_KEY, F.struct("warning_cents", "critical_cents").alias("n_bounds")
    )
    joined = opening.join(bounds, S.ACCOUNT_KEY, "full")
    new = ["bounds"]
    if newest is not None:
        last = newest.select(*S.ACCOUNT_KEY, *[F.col(t).alias(f"n_{t}") for t in totals])
        joined, new = joined.join(last, S.ACCOUNT_KEY, "full"), [*totals, "bounds"]
    return joined.select(*S.ACCOUNT_KEY, *[F.coalesce(f"n_{c}", c).alias(c) if c in new else F.col(c) for c in [*totals, "bounds"]])
