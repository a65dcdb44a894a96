"""What the streaming jobs share, and the simple ones: rejects, window flows, feed health, rail merger."""

import threading
import time
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from cashtide import schemas as S
from cashtide.functions.keys import account_key
from cashtide.operators import alerts, feeds, flows, quality
from cashtide.operators.merges import upsert
from cashtide.operators.positions import position_rows
from cashtide.sources.payments import merge_rails, routed
from cashtide.sources.tables import VersionedTable, write_batch

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass
class RunReport:
    """What an available-now run read, and how long each batch with input took."""

    name: str
    rows: int
    batch_seconds: list[float]


REPORTS: list[RunReport] = []  # of this process, for the benchmark


@dataclass
class Output:
    """Where a job writes: tables under ``root``, and Kafka if servers are given."""

    root: str
    kafka_servers: str | None = None

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def publish(self, messages: DataFrame, name: str, batch_id: int) -> None:
        """Messages (topic, key, value): to Kafka, or to a table of the same rows without it."""
        if self.kafka_servers:
            messages.write.format("kafka").options(**kafka_sink_options(self.kafka_servers)).save()
        else:
            write_batch(messages, self.table(f"topics/{name}"), batch_id)


def kafka_sink_options(servers: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "kafka.acks": "all"}


def configure(spark: SparkSession) -> None:
    """State lives in RocksDB, with small changelog uploads per batch for fast recovery."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def start(writer, name: str, output: Output, available_now: bool) -> StreamingQuery:
    writer = writer.queryName(name).option("checkpointLocation", output.table(f"checkpoints/{name}"))
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 second"}
    return writer.trigger(**trigger).start()


def run_to_end(query: StreamingQuery) -> RunReport:
    """Wait until an available-now query has read its input.

    A query with processing-time timers never ends by itself: it keeps running empty batches in
    case a timer fires.  What counts as its end are the committed offsets: it is stopped after two
    batches in a row in which no source moved on.  Files without rows move a source on; the first
    batch after a restart may repeat an interrupted one, with input still to come.
    """
    seen = {}
    while query.isActive:
        recent = query.recentProgress
        seen |= {p.batchId: p for p in recent}
        if len(recent) > 1 and not any(_moved_on(p) for p in recent[-2:]):
            _between_batches(query)
            query.stop()
            break
        query.awaitTermination(0.2)
    if query.exception() is not None:
        raise query.exception()
    seen |= {p.batchId: p for p in query.recentProgress}
    batches = [p for p in seen.values() if p.numInputRows]
    report = RunReport(query.name, sum(p.numInputRows for p in batches), [p.batchDuration / 1000 for p in batches])
    REPORTS.append(report)
    return report


def run_batches(query: StreamingQuery, count: int) -> None:
    """Stop a query once ``count`` batches with input are committed; a batch under way is cut short.

    What such a batch has written is written again, under the same batch id, when the query is reopened.
    """
    seen = set()
    while query.isActive and len(seen) < count:
        query.awaitTermination(0.05)
        seen |= {p.batchId for p in query.recentProgress if p.numInputRows}
    query.stop()


def _moved_on(progress) -> bool:
    return progress.numInputRows > 0 or any(s.startOffset != s.endOffset for s in progress.sources)


def _between_batches(query: StreamingQuery, seconds: float = 5.0) -> None:
    """Wait for a moment without a running batch; only empty batches run by now."""
    limit = time.monotonic() + seconds
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < limit:
        time.sleep(0.01)


# ---- dead letters and positions ------------------------------------------------------------


def start_rejects(checked: DataFrame, output: Output, available_now: bool = False) -> StreamingQuery:
    """Refused messages to the dead-letter table and topic (stateless)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_letters(quality.dead_letters(batch), "payments_dlq_parse", batch_id, output)

    writer = quality.rejected_payments(checked).writeStream.foreachBatch(write)
    return start(writer, "rejects", output, available_now)


def write_letters(letters: DataFrame, name: str, batch_id: int, output: Output) -> None:
    letters = letters.persist()
    try:
        write_batch(letters, output.table(name), batch_id, "detected_at")
        messages = letters.select(
            F.lit(S.DLQ_TOPIC).alias("topic"),
            account_key(F.col("currency"), F.col("settlement_account")).alias("key"),
            F.to_json(F.struct(*S.DLQ.names)).alias("value"),
        )
        output.publish(messages, name, batch_id)
    finally:
        letters.unpersist()


def write_positions(ledger: DataFrame, newest: DataFrame, batch_id: int, output: Output) -> None:
    """The upserted positions table and the alerts of one batch of ledger rows; ``newest`` has an account's last."""
    newest = newest.withColumnRenamed("payment_id", "last_payment_id")
    table, table_key = positions_table(ledger.sparkSession, output), S.TABLE_KEYS["liquidity_positions"]
    table.write(upsert(table.read(before=batch_id), position_rows(newest), table_key, ["payment_count"]), batch_id)

    # Payment ids are unique per account here and a replay replaces its folder, so the alert key is unique.
    found = alerts.alert_rows(alerts.alerts(ledger))
    write_batch(found, output.table("alert_log"), batch_id, "triggered_at")
    output.publish(alerts.alert_messages(found), "alerts", batch_id)


def positions_table(spark: SparkSession, output: Output) -> VersionedTable:
    return VersionedTable(spark, output.table("liquidity_positions"), S.TABLES["liquidity_positions"])


# ---- window flows -------------------------------------------------------------------------


class Delays(StreamingQueryListener):
    """From arrival to table: how long the rows of timed streams waited until their batch was committed.

    A batch reports its first and last arrival; between them rows are taken to arrive evenly.
    """

    def __init__(self):
        self.batches: list[tuple[int, float, float]] = []  # rows, least delay, most

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(ARRIVALS)
        if row is None or not row["rows"]:
            return
        end = datetime.fromisoformat(event.progress.timestamp).timestamp() + event.progress.batchDuration / 1000
        self.batches.append((row["rows"], end - row["last_ms"] / 1000, end - row["first_ms"] / 1000))

    def onQueryTerminated(self, event) -> None:
        pass

    def percentile(self, share: float) -> float | None:
        """Delay in seconds that ``share`` of the rows stayed below."""
        points = sorted((low + (high - low) * (i + 0.5) / 20, rows / 20) for rows, low, high in self.batches for i in range(20))
        wanted = share * sum(weight for _, weight in points)
        for delay, weight in points:
            wanted -= weight
            if wanted <= 0:
                return delay
        return None


ARRIVALS = "arrivals"


def timed(rows: DataFrame) -> DataFrame:
    """A stream whose batches report the first and last arrival of their rows, for ``Delays``."""
    millis = F.unix_millis("arrived")
    return rows.observe(ARRIVALS, F.count("arrived").alias("rows"), F.min(millis).alias("first_ms"), F.max(millis).alias("last_ms"))


class RowCounts(StreamingQueryListener):
    """Rows that the flow windows of a query took in and gave out, over all its batches.

    Once a query has closed all its windows, the difference are the rows that came too late for theirs.
    """

    def __init__(self):
        self.taken: dict[str, int] = {}
        self.given: dict[str, int] = {}
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        query = str(event.progress.id)
        for name, counts in ((FLOW_INPUT, self.taken), (FLOW_OUTPUT, self.given)):
            row = event.progress.observedMetrics.get(name)
            if row is not None:
                counts[query] = counts.get(query, 0) + (row["rows"] or 0)

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.id))
            self._change.notify_all()

    def late(self, query: StreamingQuery, seconds: float = 60) -> int:
        """Rows dropped, once a query has ended whose windows are all closed; its reports come a moment later."""
        with self._change:
            if not self._change.wait_for(lambda: str(query.id) in self._ended, seconds):
                raise TimeoutError(f"no report of the end of query {query.id}")
        return self.taken.get(str(query.id), 0) - self.given.get(str(query.id), 0)


FLOW_INPUT, FLOW_OUTPUT = "flow_input", "flow_output"


def windowed_flows(payments: DataFrame) -> DataFrame:
    """Flows with a watermark: windows close one second after their end, later rows are dropped.

    Rows without an account (ticks) move the watermark on and are counted nowhere.
    """
    seen = payments.observe(FLOW_INPUT, F.count_if(F.col("settlement_account").isNotNull()).alias("rows"))
    found = flows.flow_rows(flows.flow_summary(seen.withWatermark("event_time", S.WATERMARK_DELAY)))
    return found.observe(FLOW_OUTPUT, F.sum(F.when(F.col("settlement_account").isNotNull(), F.col("payment_count"))).alias("rows"))


def start_flows(payments: DataFrame, output: Output, available_now: bool = False) -> StreamingQuery:
    """Closed windows appended to ``liquidity_flow_summary``; each window is written once."""
    configure(payments.sparkSession)
    writer = windowed_flows(payments).writeStream.outputMode("append").foreachBatch(
        lambda batch, batch_id: write_batch(batch.where(F.col("settlement_account").isNotNull()), output.table("liquidity_flow_summary"), batch_id, "window_start")
    )
    return start(writer, "flows", output, available_now)


# ---- feed health ---------------------------------------------------------------------------


def start_feed_health(
    payments: DataFrame, output: Output, available_now: bool = False, as_of: datetime | None = None
) -> StreamingQuery:
    """Keep the feed-health table, one row for every rail from the first batch on.

    Events of the last minute are counted over all batches: counts per rail and instant are kept
    beside the table, newer events included, which count once the time has come.  No batch runs without input, so readers judge staleness when they read, with
    ``feeds.stale_at``.  ``as_of`` fixes the moment that "last minute" ends (default: now).
    """
    spark = payments.sparkSession
    configure(spark)
    table = feed_health_table(spark, output)
    recent = VersionedTable(spark, output.table("feed_recent"), feeds.RECENT)

    def merge(batch: DataFrame, batch_id: int) -> None:
        moment = as_of or datetime.now(timezone.utc)
        earlier = recent.read(before=batch_id)
        counts = feeds.merge_recent(earlier, batch, moment).persist()
        try:
            recent.write(counts, batch_id)
            table.write(feeds.health_from(table.read(before=batch_id), batch, earlier, counts, moment), batch_id)
        finally:
            counts.unpersist()

    return start(payments.writeStream.foreachBatch(merge), "feed_health", output, available_now)


def feed_health_table(spark: SparkSession, output: Output) -> VersionedTable:
    return VersionedTable(spark, output.table("feed_health"), S.TABLES["feed_health"])


# ---- rail merger --------------------------------------------------------------------------


def start_merger(rails: list[DataFrame], output: Output, available_now: bool = False) -> StreamingQuery:
    """Rail messages to the merged topic, keyed by account."""
    merged = routed(merge_rails([r.select("raw") for r in rails])).select(
        F.lit(S.PAYMENTS_TOPIC).alias("topic"), "key", "value"
    )
    writer = merged.writeStream.foreachBatch(lambda batch, batch_id: output.publish(batch, "payments", batch_id))
    return start(writer, "merger", output, available_now)


def start_console(stream: DataFrame, output: Output, name: str, available_now: bool = False) -> StreamingQuery:
    """Print a stream, for looking at a job while it runs."""
    mode = "update" if name == "engine_console" else "append"
    return start(stream.writeStream.format("console").outputMode(mode), name, output, available_now)
