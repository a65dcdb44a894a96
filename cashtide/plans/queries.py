"""Every operator as a query over the given tables: name -> f(spark, sf_dir)."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cashtide import schemas as S
from cashtide.functions.money import inbound, outbound, to_double, wide_sum
from cashtide.operators import alerts, duplicates, feeds, flows, pending, positions, quality, thresholds
from cashtide.plans import panels
from cashtide.sources import driver_tables as D
from cashtide.sources.payments import merge_rails, routed, spread, topic_files
from cashtide.sources.tables import part_files, read_batches
from cashtide.sources.workspace import new_path
from cashtide.streaming import engine, identity, jobs, silence

AS_OF = datetime(2024, 1, 31, tzinfo=timezone.utc)
PENDING_AS_OF = datetime(2024, 1, 15, 12, tzinfo=timezone.utc)
# The derived feed has minutes between payments; 60 s would flag nearly every row.
GAP_SECONDS = 7_200
HEALTH_AS_OF = datetime(2024, 1, 30, 20, tzinfo=timezone.utc)
HEALTH_TIMEOUT_SECONDS = 43_200

QUERIES = {}


def query(function):
    """Register a query; its result gets plain types (DOUBLE money, zone-free timestamps)."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return plain_types(function(spark, sf_dir))

    run.__name__, run.__doc__ = function.__name__, function.__doc__
    QUERIES[function.__name__] = run
    return run


def plain_types(df: DataFrame) -> DataFrame:
    out = []
    for field in df.schema.fields:
        value = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            value = value.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        out.append(value.alias(field.name))
    return df.select(*out)


def _events(spark, sf_dir, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
    """Events in [since, until); the bounds are on the stored column, so parquet can skip."""

    def stored(moment):
        return F.lit(f"{moment:%Y-%m-%d %H:%M:%S}").cast("timestamp_ntz")

    events = D.table(spark, sf_dir, "events")
    if since is not None:
        events = events.where(F.col("ts") >= stored(since))
    if until is not None:
        events = events.where(F.col("ts") < stored(until))
    return events


def _payments(spark, sf_dir, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
    return D.payments(_events(spark, sf_dir, since, until))


def _updates(spark, sf_dir) -> DataFrame:
    updates = D.threshold_updates(D.table(spark, sf_dir, "orders"))
    return thresholds.check_updates(thresholds.normalized(updates))


def _latest(spark, sf_dir) -> DataFrame:
    return thresholds.latest_thresholds(thresholds.accepted(_updates(spark, sf_dir)))


def _checked(spark, sf_dir) -> DataFrame:
    return quality.check(D.raw_feed(_events(spark, sf_dir)))


def _valid(spark, sf_dir) -> DataFrame:
    return quality.valid_payments(_checked(spark, sf_dir), "seq", "arrived")


def _stored(spark, sf_dir) -> DataFrame:
    """The checked feed as a table, for queries that read it more than once."""
    return quality.stored_verdicts(_checked(spark, sf_dir))


def _stored_valid(spark, sf_dir) -> DataFrame:
    return quality.valid_payments(_stored(spark, sf_dir), "seq", "arrived")


def _in_double(df: DataFrame, **names: str) -> DataFrame:
    """Replace cents columns by DOUBLE amounts: new name = cents column."""
    for new, cents in names.items():
        df = df.withColumn(new, to_double(F.col(cents)))
    return df.drop(*names.values())


_BALANCES = {
    "available_balance": "balance_cents",
    "total_inbound": "inbound_cents",
    "total_outbound": "outbound_cents",
}
_FLOWS = {"net_flow": "net_cents", "total_inbound": "inbound_cents", "total_outbound": "outbound_cents"}
_ALERTS = {
    "available_balance": "balance_cents",
    "threshold_value": "threshold_cents",
    "breach_amount": "breach_cents",
}


# ---- positions ----------------------------------------------------------------------------


@query
def current_positions(spark, sf_dir):
    """End state per account."""
    return _in_double(positions.current_positions(_payments(spark, sf_dir)), **_BALANCES).orderBy(*S.ACCOUNT_KEY)


@query
def position_ledger(spark, sf_dir):
    """Running balance, totals and count, one row per payment."""
    ledger = positions.position_ledger(_payments(spark, sf_dir).drop("counterparty"))
    return _in_double(ledger, amount="amount_cents", **_BALANCES)


@query
def position_ledger_daily(spark, sf_dir):
    """The same with totals that restart every day."""
    ledger = positions.position_ledger(_payments(spark, sf_dir), reset="day")
    out = _in_double(ledger, **_BALANCES)
    return out.select("payment_id", *S.ACCOUNT_KEY, "business_date", *_BALANCES, "payment_count")


@query
def balance_timeline_8h(spark, sf_dir):
    """Ledger of the last eight hours; history before it enters only as opening totals."""
    since = AS_OF - timedelta(hours=8)
    opening = _payments(spark, sf_dir, until=since).groupBy(*S.ACCOUNT_KEY).agg(
        wide_sum(inbound()).alias("inbound_cents"),
        wide_sum(outbound()).alias("outbound_cents"),
        F.count(F.lit(1)).alias("payment_count"),
    )
    recent = positions.position_ledger(_payments(spark, sf_dir, since), opening=opening)
    return (
        _in_double(recent, **_BALANCES)
        .select(
            F.col("event_time").alias("time"), F.col("available_balance").alias("value"),
            F.col("settlement_account").alias("metric"), "seq",
        )
        .orderBy("time", "seq")
        .drop("seq")
    )


@query
def recent_positions_8h(spark, sf_dir):
    """Stored positions updated in the last eight hours."""
    table = positions.position_rows(positions.current_positions(_payments(spark, sf_dir)), F.col("event_time"))
    return panels.recent_positions(table, AS_OF)


@query
def position_gauge(spark, sf_dir):
    """Positions against their own bounds, with a traffic light."""
    table = positions.position_rows(positions.current_positions(_payments(spark, sf_dir)), F.col("event_time"))
    return panels.traffic_light(table, thresholds.threshold_rows(_latest(spark, sf_dir)))


@query
def position_panel(spark, sf_dir):
    """Balance per account for the gauge."""
    table = positions.position_rows(positions.current_positions(_payments(spark, sf_dir)), F.col("event_time"))
    return panels.position_gauge(table)


# ---- alerts -------------------------------------------------------------------------------


def _latest_alerts(spark, sf_dir):
    ledger = positions.position_ledger(_payments(spark, sf_dir))
    return alerts.alerts(thresholds.with_latest_bounds(ledger, _latest(spark, sf_dir)))


@query
def liquidity_alerts(spark, sf_dir):
    """Alerts judged by the latest bounds."""
    return _in_double(_latest_alerts(spark, sf_dir), **_ALERTS)


@query
def alerts_asof_thresholds(spark, sf_dir):
    """Alerts judged by the bounds in force at each payment."""
    history = thresholds.accepted(_updates(spark, sf_dir))
    ledger = positions.position_ledger(_payments(spark, sf_dir), history)
    return _in_double(alerts.alerts(ledger), **_ALERTS)


@query
def alert_topic_messages(spark, sf_dir):
    """Alerts as messages for the two topics; fields are read back from the encoded text."""
    messages = alerts.alert_messages(alerts.alert_rows(_latest_alerts(spark, sf_dir)))
    fields = "type STRING, alert_type STRING, payment_id STRING, breach_amount DOUBLE, triggered_at_ts BIGINT, triggered_at STRING"
    return messages.withColumn("m", F.from_json("value", fields)).select("topic", "key", "m.*")


# ---- flows --------------------------------------------------------------------------------


@query
def flow_summary_5min(spark, sf_dir):
    """Five-minute flows per account."""
    return _in_double(flows.flow_summary(_payments(spark, sf_dir)), **_FLOWS)


@query
def flow_summary_feed(spark, sf_dir):
    """Flows of the validated feed; repeated messages count."""
    return _in_double(flows.flow_summary(_valid(spark, sf_dir)), **_FLOWS)


@query
def flow_summary_dedup(spark, sf_dir):
    """Flows of the validated feed without repeated messages."""
    firsts = duplicates.first_occurrences(_stored_valid(spark, sf_dir))
    return _in_double(flows.flow_summary(firsts), **_FLOWS)


@query
def net_flow_by_currency(spark, sf_dir):
    """Net flow per currency and window in the last two hours; the scan starts there too."""
    since = AS_OF - timedelta(hours=2)
    flow = flows.flow_by_currency(_payments(spark, sf_dir, since))
    return _in_double(flow, net_flow="net_cents").orderBy("window_start", "currency")


@query
def account_flow_panel(spark, sf_dir):
    """The panel's own rows: account flows of the last two hours."""
    since = AS_OF - timedelta(hours=2)
    return panels.account_flows(flows.flow_rows(flows.flow_summary(_payments(spark, sf_dir, since))), AS_OF)


# ---- thresholds ---------------------------------------------------------------------------


@query
def latest_thresholds(spark, sf_dir):
    """Newest accepted bounds per account."""
    return panels.threshold_list(_in_double(
        _latest(spark, sf_dir), warning_threshold="warning_cents", critical_threshold="critical_cents"
    ))


@query
def threshold_updates_rejected(spark, sf_dir):
    """Updates that cannot be applied, with the reason."""
    return thresholds.rejected(_updates(spark, sf_dir)).select("seq", *S.ACCOUNT_KEY, "error")


def _published(spark, sf_dir):
    updates = thresholds.normalized(D.threshold_updates(D.table(spark, sf_dir, "orders")))
    noon = F.lit(PENDING_AS_OF)
    before = thresholds.accepted(thresholds.check_updates(updates.where(F.col("updated_at") < noon)))
    current = thresholds.latest_thresholds(before)
    later = updates.where(F.col("updated_at") >= noon)
    return thresholds.publish_updates(later, current)


@query
def threshold_upsert(spark, sf_dir):
    """Thresholds table after publishing the second half of the updates over the first."""
    table = thresholds.threshold_rows(_published(spark, sf_dir)[1])
    return panels.threshold_list(table)


@query
def threshold_messages(spark, sf_dir):
    """Messages of that publication."""
    fields = "warning_threshold DOUBLE, critical_threshold DOUBLE, updated_by STRING, updated_at STRING"
    return (
        _published(spark, sf_dir)[0]
        .withColumn("m", F.from_json("value", fields))
        .select("topic", "key", "m.*")
    )


# ---- quality ------------------------------------------------------------------------------


@query
def payments_valid(spark, sf_dir):
    """Accepted payments of the raw feed."""
    return _in_double(_valid(spark, sf_dir), amount="amount_cents").drop("arrived")


@query
def payments_dlq(spark, sf_dir):
    """Refused messages of the raw feed with stage and reason."""
    return quality.rejected_payments(_checked(spark, sf_dir), F.col("arrived"))


@query
def payments_dedup(spark, sf_dir):
    """Accepted payments without later copies."""
    firsts = duplicates.first_occurrences(_stored_valid(spark, sf_dir))
    return _in_double(firsts, amount="amount_cents").drop("arrived")


@query
def duplicate_dlq(spark, sf_dir):
    """Dead letters of the later copies."""
    return duplicates.duplicate_letters(duplicates.later_copies(_stored_valid(spark, sf_dir)), F.col("arrived"))


def _all_letters(spark, sf_dir):
    checked = _stored(spark, sf_dir)
    refused = quality.rejected_payments(checked, F.col("arrived"))
    copies = duplicates.later_copies(quality.valid_payments(checked, "seq", "arrived"))
    return quality.dead_letters(refused, duplicates.duplicate_letters(copies, F.col("arrived")))


@query
def dlq_all(spark, sf_dir):
    """The dead-letter table: refused messages and duplicates in one layout."""
    return _all_letters(spark, sf_dir)


@query
def dlq_by_stage(spark, sf_dir):
    """Dead letters per stage."""
    return quality.count_by_stage(_all_letters(spark, sf_dir))


@query
def dlq_by_stage_5min(spark, sf_dir):
    """Dead letters per stage and five minutes."""
    return quality.count_by_stage(_all_letters(spark, sf_dir), S.FLOW_WINDOW)


@query
def merged_rails(spark, sf_dir):
    """Three rails in one stream of keyed messages."""
    tables = [D.table(spark, sf_dir, name) for name in ("events", "orders", "lineitem")]
    return routed(merge_rails(D.rail_feeds(*tables)))


# ---- feeds --------------------------------------------------------------------------------


@query
def feed_gaps(spark, sf_dir):
    """Silences of the account feeds, open ones included."""
    return feeds.feed_gaps(_payments(spark, sf_dir), AS_OF, GAP_SECONDS)


@query
def rail_health(spark, sf_dir):
    """Liveness per rail."""
    return feeds.rail_health(_payments(spark, sf_dir), AS_OF)


@query
def feed_health_table(spark, sf_dir):
    """Feed-health table after merging a newer observation of two rails over an older one of all."""
    payments = _payments(spark, sf_dir)
    older = feeds.rail_health(payments, PENDING_AS_OF)
    newer = feeds.rail_health(payments, AS_OF).where(F.col("rail") != "CHAPS")
    return feeds.update_feed_health(older, newer)


@query
def feed_status(spark, sf_dir):
    """0/1 stale flag per rail."""
    return panels.feed_status(feeds.rail_health(_payments(spark, sf_dir), AS_OF), AS_OF)


@query
def rail_volume_by_hours(spark, sf_dir):
    """Volume per rail in and out of business hours."""
    return _in_double(feeds.volume_by_hours(_payments(spark, sf_dir)), amount="amount_cents")


# ---- pending ------------------------------------------------------------------------------


def _refreshed(spark, sf_dir):
    events = _events(spark, sf_dir)
    incoming = D.pending_incoming(events, D.table(spark, sf_dir, "orders"))
    return pending.refresh_pending(D.pending_current(events), incoming, PENDING_AS_OF)


@query
def pending_refreshed(spark, sf_dir):
    """Pending table after one refresh."""
    return _refreshed(spark, sf_dir)[0]


@query
def pending_refresh_summary(spark, sf_dir):
    """Row counts of that refresh."""
    return _refreshed(spark, sf_dir)[1]


@query
def pending_queue(spark, sf_dir):
    """Next 50 due rows."""
    return panels.pending_queue(D.pending_current(_events(spark, sf_dir)), PENDING_AS_OF)


@query
def pending_top10_debits(spark, sf_dir):
    """Ten largest outbound rows due within two hours."""
    top = pending.largest_outbound(D.pending_current(_events(spark, sf_dir)), PENDING_AS_OF)
    return top.select("amount", "currency", "settlement_account", "expected_settlement_time", "counterparty", "payment_id")


# ---- streams: the given tables read as file streams, run to their end ---------------------


def _checked_stream(spark, sf_dir):
    events = D.table_stream(spark, sf_dir, "events", D.EVENTS_SCHEMA)
    return quality.check(spread(D.raw_feed(events)))


def _updates_stream(spark, sf_dir):
    orders = D.table_stream(spark, sf_dir, "orders", D.ORDERS_SCHEMA)
    updates = thresholds.normalized(D.threshold_updates(orders))
    return thresholds.check_updates(updates).withColumn("arrived", F.col("updated_at"))


def _new_output(spark, name):
    return jobs.Output(new_path(spark, name))


@query
def stream_flow_summary(spark, sf_dir):
    """Closed five-minute windows of the feed, from the windowed streaming job."""
    output = _new_output(spark, "flows")
    payments = quality.valid_payments(_checked_stream(spark, sf_dir))
    jobs.run_to_end(jobs.start_flows(payments, output, available_now=True))
    return read_batches(spark, output.table("liquidity_flow_summary"), S.TABLES["liquidity_flow_summary"])


def _engine_output(spark, sf_dir):
    output = _new_output(spark, "engine")
    checked, updates = _checked_stream(spark, sf_dir), _updates_stream(spark, sf_dir)
    jobs.run_to_end(engine.start_engine(checked, updates, output, available_now=True))
    return output


@query
def stream_positions(spark, sf_dir):
    """Positions table after the keyed streaming engine has read the whole feed."""
    output = _engine_output(spark, sf_dir)
    return jobs.positions_table(spark, output).read().drop("last_updated")


@query
def stream_alerts(spark, sf_dir):
    """Alert log of the keyed streaming engine, thresholds changing while it runs."""
    output = _engine_output(spark, sf_dir)
    return read_batches(spark, output.table("alert_log"), S.TABLES["alert_log"])


@query
def stream_dlq(spark, sf_dir):
    """Dead letters of the streaming jobs: refused messages and duplicates."""
    output = _engine_output(spark, sf_dir)
    jobs.run_to_end(jobs.start_rejects(_checked_stream(spark, sf_dir), output, available_now=True))
    parts = [read_batches(spark, output.table(f"payments_dlq_{p}"), S.DLQ) for p in ("parse", "duplicates")]
    return quality.dead_letters(*parts).drop("detected_at")


_CUTS = [datetime(2024, 1, day, tzinfo=timezone.utc) for day in (8, 15, 23)]


def _quarter(time):
    """0 to 3, by fixed cuts of the month."""
    return sum([F.when(time >= F.lit(cut), 1).otherwise(0) for cut in _CUTS], F.lit(0))


FILE_ROWS = 200_000  # of a stored micro-batch, where it has more


def _in_files(rows, number, batches=4, file_rows=FILE_ROWS):
    """Stored rows as a stream of micro-batches; ``number`` says which one, from 0.

    A trigger takes a fixed number of files, so every batch has as many as the largest one needs, written by
    as many tasks; a batch that fills fewer gets empty files.
    """
    spark, folder = rows.sparkSession, new_path(rows.sparkSession, "files")
    largest = rows.groupBy(number.alias("batch")).count().agg(F.max("count")).first()[0]
    files = max(1, -(-(largest or 0) // file_rows))
    for wanted in range(batches):  # one after the other: files are read by their age
        part = rows.where(number == wanted)
        (part.coalesce(1) if files == 1 else part.repartition(files)).write.mode("append").parquet(folder)
        for _ in range(files * (wanted + 1) - part_files(spark, folder)):
            spark.createDataFrame([], rows.schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(folder)


def _event_quarter():
    return _quarter(F.col("ts").cast("timestamp"))


def _files_stream(spark, sf_dir):
    """The events as a stream of several files by time, one in each micro-batch."""
    return _in_files(_events(spark, sf_dir), _event_quarter())


def _ticked(events, moment):
    """Events and a row that holds a time only, which moves the clock of a stream on."""
    at = F.lit(f"{moment:%Y-%m-%d %H:%M:%S}").cast("timestamp_ntz").alias("ts")
    return events.unionByName(events.sparkSession.range(1).select(at), allowMissingColumns=True)


@query
def stream_positions_many_batches(spark, sf_dir):
    """Positions of the engine when the feed comes in several micro-batches, with copies in all.

    The last payment differs from the whole feed's where a copy opens a batch, so it is left out.
    """
    output = _new_output(spark, "many")
    checked = quality.check(spread(D.raw_feed(_files_stream(spark, sf_dir))))
    jobs.run_to_end(engine.start_engine(checked, None, output, available_now=True))
    return jobs.positions_table(spark, output).read().drop("last_updated", "last_payment_id", "event_time")


@query
def stream_restart(spark, sf_dir):
    """Positions of an engine that was stopped after two of four batches and opened again.

    Beside each account: the ids in the engine's state, read by the state data source.
    """
    output, feed = _new_output(spark, "restart"), D.raw_feed(_files_stream(spark, sf_dir))

    def opened():
        return engine.start_engine(quality.check(spread(feed)), None, output, available_now=True)

    jobs.run_batches(opened(), 2)
    jobs.run_to_end(opened())
    ids = identity.live_ids(spark, output.table("checkpoints/engine")).groupBy(*S.ACCOUNT_KEY)
    counts = ids.agg(F.count(F.lit(1)).alias("ids_in_state"), F.sum("sightings").alias("sightings"))
    return jobs.positions_table(spark, output).read().drop("last_updated", "last_payment_id", "event_time").join(counts, S.ACCOUNT_KEY, "full")


ID_TTL_SECONDS = 86_400


def resent_feed(spark, sf_dir):
    """The feed with a third message of every 97th event, three days after the first."""
    feed = D.raw_feed(_events(spark, sf_dir))
    later = feed.where(F.col("seq") % 194 == 0).withColumns({"arrived": F.col("arrived") + F.expr("INTERVAL 3 DAYS"), "seq": F.col("seq") + F.lit(1 << 40)})
    return feed.unionByName(later)


@query
def stream_id_ttl(spark, sf_dir):
    """Messages accepted and refused of every payment id when ids are remembered for one day.

    A copy after 30 seconds is refused, one after three days accepted.
    """
    output = _new_output(spark, "ttl")
    checked = quality.check(spread(_in_files(resent_feed(spark, sf_dir), _quarter(F.col("arrived")))))
    jobs.run_to_end(engine.start_engine(checked, None, output, available_now=True, id_ttl_seconds=ID_TTL_SECONDS))
    ledger = read_batches(spark, output.table("position_ledger")).select("payment_id", F.lit(True).alias("taken"))
    copies = read_batches(spark, output.table("payments_dlq_duplicates"), S.DLQ).select("payment_id", F.lit(False).alias("taken"))
    return ledger.unionByName(copies).groupBy("payment_id").agg(
        F.count_if("taken").alias("accepted"), F.count_if(~F.col("taken")).alias("refused")
    )


@query
def stream_feed_events(spark, sf_dir):
    """Silences of the account feeds from event-time timers, over several micro-batches.

    A tick moves the clock to ``AS_OF`` when the payments have ended.
    """
    output = _new_output(spark, "silences")
    events = _ticked(_events(spark, sf_dir), AS_OF + timedelta(seconds=2))  # the watermark is a second behind
    payments = D.payments(_in_files(events, _event_quarter()))
    jobs.run_to_end(silence.start_silences(payments, output, available_now=True, stale_seconds=GAP_SECONDS))
    return silence.gaps(read_batches(spark, output.table("feed_events"), silence.EVENT_TABLE))


@query
def stream_late_rows(spark, sf_dir):
    """Payments of which one in fifty comes two batches late: closed windows drop it, balances keep it."""
    output, counts = _new_output(spark, "late"), jobs.RowCounts()
    quarter = _event_quarter()
    number = F.when((F.col("event_id") % 50 == 7) & (quarter < 2), quarter + 2).otherwise(quarter)
    feed = _in_files(_ticked(_events(spark, sf_dir), AS_OF + timedelta(days=1)), number)
    spark.streams.addListener(counts)
    try:
        windows = jobs.start_flows(D.payments(feed), output, available_now=True)
        jobs.run_to_end(windows)
        checked = quality.check(spread(D.raw_feed(feed.where("event_id IS NOT NULL"))))
        jobs.run_to_end(engine.start_engine(checked, None, output, available_now=True))
        late = counts.late(windows)
    finally:
        spark.streams.removeListener(counts)
    flow = read_batches(spark, output.table("liquidity_flow_summary"), S.TABLES["liquidity_flow_summary"])
    per_account = flow.groupBy(*S.ACCOUNT_KEY).agg(F.count(F.lit(1)).alias("windows"), F.sum("payment_count").alias("in_windows"))
    balances = jobs.positions_table(spark, output).read().select(*S.ACCOUNT_KEY, "available_balance", F.col("payment_count").alias("in_balance"))
    return balances.join(per_account, S.ACCOUNT_KEY).withColumn("late_rows", F.lit(late).cast("long"))


@query
def stream_thresholds_applied(spark, sf_dir):
    """Threshold changes that the engine applied, from a dumped topic of JSON text.

    What the topic held before the engine starts is compacted and in force before the first payment; the
    rest is read as a stream.  Malformed messages change nothing, deletions remove the bounds.
    """
    output, folder = _new_output(spark, "applied"), new_path(spark, "topic")
    lines, noon = D.threshold_lines(D.table(spark, sf_dir, "orders")), F.lit(PENDING_AS_OF)
    lines.where(F.col("updated_at") < noon).select("value").write.text(f"{folder}/before")
    lines.where(F.col("updated_at") >= noon).select("value").write.text(f"{folder}/after")
    held = thresholds.compacted(thresholds.decode_messages(topic_files(spark, f"{folder}/before", stream=False)))
    updates = thresholds.decode_messages(topic_files(spark, f"{folder}/after").withColumn("arrived", F.current_timestamp()), "arrived")
    run = engine.start_engine(_checked_stream(spark, sf_dir), updates, output, available_now=True, opening_bounds=held)
    jobs.run_to_end(run)
    return read_batches(spark, output.table("thresholds_applied"), engine.APPLIED)


@query
def stream_feed_health(spark, sf_dir):
    """0/1 per rail at ``AS_OF`` from the feed-health table of a stream of several micro-batches.

    CHAPS falls silent on the 30th: its later payments come by RTGS.
    """
    output, silent = _new_output(spark, "health"), F.lit("2024-01-30 00:00:00+00:00").cast("timestamp")
    payments = D.payments(_files_stream(spark, sf_dir))
    moved = (F.col("rail") == "CHAPS") & (F.col("event_time") >= silent)
    payments = payments.withColumn("rail", F.when(moved, "RTGS").otherwise(F.col("rail")))
    jobs.run_to_end(jobs.start_feed_health(payments, output, available_now=True, as_of=HEALTH_AS_OF))
    health = jobs.feed_health_table(spark, output).read()
    flags = panels.feed_status(health, HEALTH_AS_OF, HEALTH_TIMEOUT_SECONDS)
    return flags.join(health.select("rail", "last_event_time", "event_count_1min"), "rail")


def _batches_output(spark, sf_dir):
    output = _new_output(spark, "batches")
    checked, updates = _checked_stream(spark, sf_dir), _updates_stream(spark, sf_dir)
    jobs.run_to_end(engine.start_engine(checked, updates, output, available_now=True))
    return output


@query
def batch_stream_positions(spark, sf_dir):
    """Positions table of the table-state engine, which splits hot accounts."""
    return jobs.positions_table(spark, _batches_output(spark, sf_dir)).read().drop("last_updated")


@query
def batch_stream_alerts(spark, sf_dir):
    """Alert log of the table-state engine."""
    output = _batches_output(spark, sf_dir)
    return read_batches(spark, output.table("alert_log"), S.TABLES["alert_log"])
