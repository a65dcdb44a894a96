import json
import time
from datetime import timedelta

import pandas as pd
import pytest
from helpers import MILLION, START, message, thresholds
from pyspark.sql import functions as F

from cashtide import schemas as S
from cashtide.operators import feeds, quality
from cashtide.operators import thresholds as thresholds_op
from cashtide.operators.thresholds import check_updates
from cashtide.plans import panels, queries
from cashtide.sources import driver_tables
from cashtide.sources import payments as sources
from cashtide.sources.tables import batch_stream, read_batches
from cashtide.streaming import engine, identity, jobs, silence

FEED = "raw STRING, seq BIGINT, arrived TIMESTAMP"


class Feed:
    """A folder of message files; each ``add`` is one file."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.count = spark, str(folder), 0

    def add(self, *texts, at=None):
        base = START if at is None else at
        rows = [(t, self.count + i, base + timedelta(seconds=self.count + i)) for i, t in enumerate(texts)]
        self.count += len(texts)
        self.spark.createDataFrame(rows, FEED).coalesce(1).write.mode("append").parquet(self.folder)

    def checked(self):
        return quality.check(self.spark.readStream.schema(FEED).parquet(self.folder))


def payment(number, amount, at=0, **more):
    text = (START + timedelta(seconds=at)).isoformat(timespec="milliseconds").replace("+00:00", "Z")
    direction = "CREDIT" if amount > 0 else "DEBIT"
    return message(payment_id=f"p-{number}", amount=abs(amount), direction=direction, event_time=text, **more)


def updates_stream(spark, folder, changes):
    rows = check_updates(thresholds(spark, changes)).selectExpr("*", "updated_at AS arrived")
    rows.coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(rows.schema).parquet(str(folder))


def run_engine(*args, **kwargs):
    return jobs.run_to_end(engine.start_engine(*args, available_now=True, **kwargs))


def position(spark, output):
    return jobs.positions_table(spark, output).read().first()


def test_restart_and_redelivery(spark, tmp_path):
    """State survives a restart; a payment sent again after it is refused, not counted."""
    feed, output = Feed(spark, tmp_path / "in"), jobs.Output(str(tmp_path / "out"))
    feed.add(payment(1, 100 * MILLION), payment(2, -20 * MILLION), payment(2, -20 * MILLION))
    run_engine(feed.checked(), None, output)
    assert int(position(spark, output)["available_balance"]) == 80 * MILLION
    feed.add(payment(1, 100 * MILLION), payment(3, 10 * MILLION))
    run_engine(feed.checked(), None, output)
    row = position(spark, output)
    assert (int(row["available_balance"]), row["payment_count"], row["last_payment_id"]) == (90 * MILLION, 3, "p-3")
    letters = read_batches(spark, output.table("payments_dlq_duplicates"), S.DLQ).collect()
    assert sorted((r["payment_id"], r["stage"]) for r in letters) == [
        ("p-1", S.STAGE_DUPLICATE),
        ("p-2", S.STAGE_DUPLICATE),
    ]


def test_messages_are_read_and_parsed_once_a_batch(spark, tmp_path):
    """Rows and ids share one shuffle of parsed payments, with and without a time limit."""
    feed = Feed(spark, tmp_path / "in")
    feed.add(*[payment(n % 8, 10 * MILLION) for n in range(10)])
    for ttl in (None, 86_400):
        output = jobs.Output(str(tmp_path / f"out-{ttl}"))
        assert run_engine(feed.checked(), None, output, id_ttl_seconds=ttl).rows == 10
        assert position(spark, output)["payment_count"] == 8


def test_a_micro_batch_is_stored_in_several_files(spark, tmp_path):
    """Each batch has the rows of its own number, whatever the sizes of the others; none, few or null too."""
    sizes = {0: 700, 1: 0, 2: 1, 3: 40}
    rows = [(batch, i) for batch, size in sizes.items() for i in range(size)]
    stored = spark.createDataFrame([*rows, (None, None)], "batch INT, i INT")
    stream = queries._in_files(stored, F.col("batch"), file_rows=100)
    found = {}

    def take(batch, batch_id):
        counts = batch.groupBy("batch").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("i").alias("ids"), F.countDistinct("_file").alias("files"))
        found[batch_id] = [tuple(r) for r in counts.collect()]

    named = stream.withColumn("_file", F.col("_metadata.file_name"))
    query = named.writeStream.foreachBatch(take).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    jobs.run_to_end(query)
    assert found == {0: [(0, 700, 700, 7)], 1: [], 2: [(2, 1, 1, 1)], 3: [(3, 40, 40, found[3][0][3])]}


def test_a_message_is_written_once_in_the_plan(spark):
    """Repeated in every branch of the faults, its code was too long to be compiled; the rows are the same."""
    events = spark.range(40).selectExpr("id AS event_id", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts", "id AS user_id", "'click' AS event_type", "1.5D AS value", "'' AS props")
    feed = driver_tables.raw_feed(events)
    plan = feed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("date_format") == 1
    rows = {r["seq"]: r["raw"] for r in feed.collect()}
    assert json.loads(rows[30])["payment_id"] == "P15" and rows[26] == f"{rows[26][:len(rows[26]) // 2]} {rows[26][:len(rows[26]) // 2]}"
    assert rows[24].endswith("}" + "x" * 600) and rows[28].endswith("}}") and rows[2] == "not valid json {{ P1" and rows[20] == '["P10"]'


def test_late_payment_counts_in_the_balance(spark, tmp_path):
    feed, output = Feed(spark, tmp_path / "in"), jobs.Output(str(tmp_path / "out"))
    feed.add(payment(1, 100 * MILLION, at=7200))
    run_engine(feed.checked(), None, output)
    feed.add(payment(2, 50 * MILLION, at=0))
    run_engine(feed.checked(), None, output)
    assert int(position(spark, output)["available_balance"]) == 150 * MILLION


def test_thresholds_change_while_running(spark, tmp_path):
    feed, output = Feed(spark, tmp_path / "in"), jobs.Output(str(tmp_path / "out"))
    feed.add(payment(1, 300 * MILLION))
    changes = [(-10, 2000 * MILLION, 100 * MILLION)]
    run_engine(feed.checked(), updates_stream(spark, tmp_path / "thr", changes), output)
    feed.add(payment(2, 11 * MILLION))  # arrives one second after the first
    changes = [(0, 2000 * MILLION, 500 * MILLION)]
    run_engine(feed.checked(), updates_stream(spark, tmp_path / "thr", changes), output)
    found = read_batches(spark, output.table("alert_log"), S.TABLES["alert_log"]).collect()
    assert sorted((r["payment_id"], r["alert_type"]) for r in found) == [("p-1", "WARNING"), ("p-2", "CRITICAL")]
    topics = read_batches(spark, output.table("topics/alerts"), spark.createDataFrame([], "topic STRING, key STRING, value STRING").schema)
    assert sorted(r["topic"] for r in topics.collect()) == [S.CRITICAL_TOPIC, S.WARNING_TOPIC]


def test_replayed_batch_leaves_the_same_tables(spark, tmp_path):
    """A batch whose commit is lost runs again: same balance, same letters, same state."""
    feed, output = Feed(spark, tmp_path / "in"), jobs.Output(str(tmp_path / "out"))
    feed.add(*[payment(n % 3, 10 * MILLION) for n in range(5)])
    run_engine(feed.checked(), None, output)
    feed.add(*[payment(n % 4, 10 * MILLION) for n in range(5)])
    for lost in (False, True):
        run_engine(feed.checked(), None, output)
        row = position(spark, output)
        assert (row["payment_count"], int(row["available_balance"])) == (4, 40 * MILLION)
        assert read_batches(spark, output.table("payments_dlq_duplicates"), S.DLQ).count() == 2 + 4
        ids = identity.live_ids(spark, output.table("checkpoints/engine")).collect()
        assert sorted((r.payment_id, r.sightings) for r in ids) == [("p-0", 4), ("p-1", 3), ("p-2", 2), ("p-3", 1)]
        if not lost:
            commits = tmp_path / "out/checkpoints/engine/commits"
            last = max((p for p in commits.iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
            last.rename(tmp_path / "lost-commit")
            for crc in commits.glob(f".{last.name}.crc"):
                crc.rename(tmp_path / "lost-commit.crc")


def test_hot_account_keeps_all_tasks_busy(spark, tmp_path):
    """Nine in ten payments are of one account: its ids and its balances are spread over all tasks."""
    rows = spark.range(4_000).select(
        F.lit("GBP").alias("currency"),
        F.when(F.col("id") % 10 == 0, "CHAPS-GBP-001").otherwise("RTGS-GBP-001").alias("settlement_account"),
        F.concat(F.lit("p-"), F.col("id")).alias("payment_id"),
        F.lit(100).cast("long").alias("amount_cents"),
        F.lit("CREDIT").alias("direction"),
        *[F.lit(None).cast("string").alias(c) for c in ("rail", "counterparty", "stage")],
        *[F.timestamp_seconds(F.col("id") + 1_700_000_000).alias(c) for c in ("event_time", "arrived")],
        F.col("id").alias("seq"),
    )
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    output = jobs.Output(str(tmp_path / "out"))
    run_engine(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), None, output, ranges=4)
    found = {r["settlement_account"]: r["payment_count"] for r in jobs.positions_table(spark, output).read().collect()}
    assert found == {"RTGS-GBP-001": 3_600, "CHAPS-GBP-001": 400}
    hot = F.col("settlement_account") == "RTGS-GBP-001"
    ids = identity.live_ids(spark, output.table("checkpoints/engine")).where(hot)
    per_task = [r["count"] for r in ids.groupBy("partition_id").count().collect()]
    assert len(per_task) == 4 and max(per_task) < 1.3 * min(per_task)
    ledger = read_batches(spark, output.table("position_ledger")).where(hot)
    assert ledger.count() == ledger.select("balance_cents").distinct().count() == 3_600
    assert ledger.agg(F.max("balance_cents")).first()[0] == 360_000


@pytest.mark.parametrize("cut", [1, 3])
def test_ids_expire(spark, tmp_path, cut):
    """With a limit of a day: a copy inside is refused, one outside accepted, however the input is cut."""
    hours = [0, 1, 23, 30, 60, 200, 201, 223]  # gaps of 1, 22, 7, 30, 140, 1 and 22 hours
    rows = [(payment(1, 10 * MILLION), i, START + timedelta(hours=h)) for i, h in enumerate(hours)]
    folder, output = tmp_path / "in", jobs.Output(str(tmp_path / "out"))
    for part in range(cut):
        chosen = rows[len(rows) * part // cut : len(rows) * (part + 1) // cut]
        spark.createDataFrame(chosen, FEED).coalesce(1).write.mode("append").parquet(str(folder))
        run_engine(quality.check(spark.readStream.schema(FEED).parquet(str(folder))), None, output, id_ttl_seconds=86_400)
    assert position(spark, output)["payment_count"] == 3
    taken = read_batches(spark, output.table("position_ledger")).orderBy("arrived").collect()
    assert [r["seq"] for r in taken] == [0, 4, 5]
    slots = identity.live_ids(spark, output.table("checkpoints/engine")).select("slot_start").distinct().count()
    assert slots <= 4 if cut > 1 else slots >= 1  # earlier slots are gone once later batches came


def test_flow_window_drops_late_rows(spark, tmp_path):
    feed, output = Feed(spark, tmp_path / "in"), jobs.Output(str(tmp_path / "out"))
    for at in (60, 720, 90, 1800):  # the third belongs to a window closed by the second
        feed.add(payment(at, 20 * MILLION, at=at))
        jobs.run_to_end(jobs.start_flows(quality.valid_payments(feed.checked()), output, available_now=True))
    rows = read_batches(spark, output.table("liquidity_flow_summary"), S.TABLES["liquidity_flow_summary"]).orderBy("window_start").collect()
    assert [(r["window_start"] - START.replace(tzinfo=None)).total_seconds() for r in rows] == [0, 600]
    assert [(r["payment_count"], int(r["net_flow"])) for r in rows] == [(1, 20 * MILLION), (1, 20 * MILLION)]


def test_silence_and_recovery_by_the_clock(spark, tmp_path):
    """Live monitoring of what the engine accepted: silence is reported, then recovery."""
    feed, output = Feed(spark, tmp_path / "in"), jobs.Output(str(tmp_path / "out"))
    feed.add(payment(1, 100 * MILLION))
    run_engine(feed.checked(), None, output)
    ledger = output.table("position_ledger")
    accepted = batch_stream(spark, ledger, read_batches(spark, ledger).schema)
    query = silence.start_silences(accepted, output, stale_seconds=2, clock="processing")

    def wait_for(kind):
        for _ in range(120):
            rows = [r for r in read_batches(spark, output.table("feed_events"), silence.EVENT_TABLE).collect() if r["type"] == kind]
            if rows:
                return rows
            assert query.isActive, query.exception()
            time.sleep(0.5)
        raise AssertionError(f"no {kind}")

    try:
        stale = wait_for("feed_stale")
        assert len(stale) == 1 and stale[0]["key"] == "GBP:RTGS-GBP-001"
        assert stale[0]["detected_at"] - stale[0]["stale_since"] == timedelta(seconds=2)
        feed.add(payment(2, 10 * MILLION))
        run_engine(feed.checked(), None, output)
        assert wait_for("feed_recovered")[0]["stale_since"] == stale[0]["stale_since"]
    finally:
        query.stop()


def test_refused_messages_reach_the_dead_letter_table(spark, tmp_path):
    feed, output = Feed(spark, tmp_path / "in"), jobs.Output(str(tmp_path / "out"))
    feed.add("not valid json {{", message(currency="CHF"), message())
    jobs.run_to_end(jobs.start_rejects(feed.checked(), output, available_now=True))
    letters = read_batches(spark, output.table("payments_dlq_parse"), S.DLQ).collect()
    assert sorted(r["stage"] for r in letters) == [S.STAGE_JSON, S.STAGE_SCHEMA]
    assert all(r["detected_at"] is not None for r in letters)


def test_feed_health_table(spark, tmp_path):
    feed, output = Feed(spark, tmp_path / "in"), jobs.Output(str(tmp_path / "out"))
    feed.add(payment(1, 20 * MILLION, at=5), payment(2, 20 * MILLION))
    jobs.run_to_end(jobs.start_feed_health(quality.valid_payments(feed.checked()), output, available_now=True))
    rows = {r["rail"]: r for r in jobs.feed_health_table(spark, output).read().collect()}
    assert sorted(rows) == S.RAILS and rows["CHAPS"]["last_event_time"] is None and rows["CHAPS"]["is_stale"]
    assert rows["RTGS"]["last_event_time"] == START.replace(tzinfo=None) + timedelta(seconds=5)


def test_feed_health_counts_the_minute_over_batches_and_turns_stale_when_read(spark, tmp_path):
    feed, output = Feed(spark, tmp_path / "in"), jobs.Output(str(tmp_path / "out"))
    for first, count in ((0, 50), (51, 3)):
        feed.add(*[payment(first + i, 20 * MILLION, at=first) for i in range(count)])
        moment = START + timedelta(seconds=52)
        jobs.run_to_end(jobs.start_feed_health(quality.valid_payments(feed.checked()), output, available_now=True, as_of=moment))
    health = jobs.feed_health_table(spark, output).read()
    assert {r["rail"]: r["event_count_1min"] for r in health.collect()} == {"RTGS": 53, "CHAPS": 0, "INTERNAL": 0}
    at = {seconds: panels.feed_status(health, START + timedelta(seconds=seconds)).collect() for seconds in (60, 200)}
    assert [r["value"] for r in at[60]] == [1, 1, 0] and [r["value"] for r in at[200]] == [1, 1, 1]


def test_feed_health_equals_the_batch_definition_at_every_moment(spark, tmp_path):
    """Boundary instants, events after the moment that count later, and late ones."""
    feed, output = Feed(spark, tmp_path / "in"), jobs.Output(str(tmp_path / "out"))
    seconds = [[0.0, 59.9999, 60.0, 61.5], [0.0005, 0.001, 90.0, 300.0], [60.0, 119.5, 150.0]]
    moments = [60, 60.001, 120, 400]
    sent = []
    for number, moment in enumerate(moments):
        times = seconds[number] if number < len(seconds) else [10.0]
        sent += times
        rows = [(payment(f"{number}-{i}", 20 * MILLION, at=t), 0, START) for i, t in enumerate(times)]
        spark.createDataFrame(rows, FEED).coalesce(1).write.mode("append").parquet(feed.folder)
        as_of = START + timedelta(seconds=moment)
        jobs.run_to_end(jobs.start_feed_health(quality.valid_payments(feed.checked()), output, available_now=True, as_of=as_of))
        ours = jobs.feed_health_table(spark, output).read().orderBy("rail").collect()
        payments = quality.valid_payments(quality.check(spark.read.schema(FEED).parquet(feed.folder)))
        assert ours == feeds.rail_health(payments, as_of).orderBy("rail").collect()


def test_empty_files_do_not_end_a_run(spark, tmp_path):
    feed, output = Feed(spark, tmp_path / "in"), jobs.Output(str(tmp_path / "out"))
    feed.add(payment(1, 100 * MILLION))
    for _ in range(4):
        spark.createDataFrame([], FEED).coalesce(1).write.mode("append").parquet(feed.folder)
    feed.add(payment(2, 10 * MILLION))
    stream = spark.readStream.schema(FEED).option("maxFilesPerTrigger", 1).parquet(feed.folder)
    run_engine(quality.check(stream), None, output)
    assert position(spark, output)["payment_count"] == 2


def test_any_cut_of_the_input_gives_the_same_tables(spark, tmp_path):
    days = [0, 0, 3 * 86_400, 3 * 86_400, 9 * 86_400]
    texts = [payment(n % 3, 10 * MILLION) for n in range(5)]
    found = []
    for cut in (1, 2, 5):
        folder, output = tmp_path / f"in{cut}", jobs.Output(str(tmp_path / f"out{cut}"))
        rows = [(t, i, START + timedelta(seconds=days[i] + i)) for i, t in enumerate(texts)]
        for part in range(cut):
            chosen = rows[len(rows) * part // cut : len(rows) * (part + 1) // cut]
            spark.createDataFrame(chosen, FEED).coalesce(1).write.mode("append").parquet(str(folder))
            run_engine(quality.check(spark.readStream.schema(FEED).parquet(str(folder))), None, output)
        row = position(spark, output)
        copies = read_batches(spark, output.table("payments_dlq_duplicates"), S.DLQ).count()
        found.append((int(row["available_balance"]), row["payment_count"], copies))
    assert found == [(30 * MILLION, 3, 2)] * 3


def test_merger_and_text_source(spark, tmp_path):
    output = jobs.Output(str(tmp_path / "out"))
    rails = []
    for rail in ("rtgs", "chaps"):
        spark.createDataFrame([(message(rail=rail.upper()),)], "value STRING").write.text(str(tmp_path / rail))
        rails.append(sources.text_stream(spark, str(tmp_path / rail)))
    jobs.run_to_end(jobs.start_merger(rails, output, available_now=True))
    rows = read_batches(spark, output.table("topics/payments")).collect()
    assert [(r["topic"], r["key"]) for r in rows] == [("payments.all", "GBP:RTGS-GBP-001")] * 2


def test_kafka_options():
    options = sources.kafka_options("broker:9092", S.RAIL_TOPICS, per_trigger=1_000)
    assert options["subscribe"] == "payments.rtgs,payments.chaps,payments.internal"
    assert options["startingOffsets"] == "earliest" and int(options["maxOffsetsPerTrigger"]) > 0
    assert "maxOffsetsPerTrigger" not in sources.kafka_options("b", ["t"])
    assert jobs.kafka_sink_options("b") == {"kafka.bootstrap.servers": "b", "kafka.acks": "all"}


def test_threshold_topic_of_text(spark):
    """Malformed messages change nothing, deletions remove bounds, and the newest usable message counts."""

    def text(warning, critical, account="RTGS-GBP-001"):
        fields = {"currency": "GBP", "settlement_account": account, "warning_threshold": warning, "critical_threshold": critical}
        return json.dumps(fields | {"updated_by": "desk", "updated_at": "2026-04-01T09:00:00Z"})

    key = "GBP:RTGS-GBP-001"
    lines = [
        f"1\t{key}\t{text(200, 100)}", f"3\t{key}\t{text(400, 300)}", f"2\t{key}\t{text(9, 8)}", f"4\t{key}\tnot json",
        f"5\t{key}\t{text(1, 2)}", f"6\tGBP:B\t{text(50, None, 'B')}", "7\tGBP:B", "8\t", "9", f"10\tGBP:C\t{text(70, 60, 'C')}\ttail",
    ]
    messages = sources.topic_lines(spark.createDataFrame([(line,) for line in lines], "value STRING"))
    decoded = thresholds_op.decode_messages(messages)
    errors = {r["seq"]: r["error"] for r in decoded.collect()}
    assert {n for n, e in errors.items() if e is None} == {1, 2, 3, 6, 7}
    assert [(r["settlement_account"], r["warning_cents"], r["critical_cents"]) for r in thresholds_op.compacted(decoded).collect()] == [
        ("RTGS-GBP-001", 40_000, 30_000)
    ]


def test_opening_bounds_hold_until_changed_or_deleted(spark, tmp_path):
    feed, output = Feed(spark, tmp_path / "in"), jobs.Output(str(tmp_path / "out"))
    opening = spark.createDataFrame([("GBP", "RTGS-GBP-001", 50_000 * MILLION, 20_000 * MILLION)], "currency STRING, settlement_account STRING, warning_cents BIGINT, critical_cents BIGINT")
    topic = tmp_path / "topic"
    topic.mkdir()

    def run():
        changes = sources.topic_files(spark, str(topic)).withColumn("arrived", F.lit(START))
        run_engine(feed.checked(), thresholds_op.decode_messages(changes, "arrived"), output, opening_bounds=opening)

    feed.add(payment(1, 300 * MILLION))
    run()
    (topic / "1.txt").write_text("1\tGBP:RTGS-GBP-001\n")
    feed.add(payment(2, 11 * MILLION))
    run()
    assert [r["payment_id"] for r in read_batches(spark, output.table("alert_log"), S.TABLES["alert_log"]).collect()] == ["p-1"]
    applied = read_batches(spark, output.table("thresholds_applied"), engine.APPLIED).collect()
    assert sorted((r["key"], r["warning"] is None) for r in applied) == [("GBP:RTGS-GBP-001", False), ("GBP:RTGS-GBP-001", True)]


# ---- the silence processor alone, with state kept in memory ---------------------------------


class Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class Handle:
    def __init__(self):
        self.timers = set()

    def getValueState(self, name, schema):
        return Value()

    def listTimers(self):
        return iter(self.timers)

    def deleteTimer(self, at):
        self.timers.discard(at)

    def registerTimer(self, at):
        self.timers.add(at)


class Clock:
    def __init__(self, now=0):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now

    getExpiryTimeInMs = getCurrentWatermarkInMs = getCurrentProcessingTimeInMs


KEY = ("GBP", "RTGS-GBP-001")
SECOND = 1_000_000


def silence_processor(by_event):
    p = silence.SilenceProcessor(60 * SECOND, by_event)
    p.init(Handle())
    return p


def heard(p, *stretches, now=0):
    rows = pd.DataFrame(stretches or [(0, 0)], columns=["first_us", "last_us"])
    found = pd.concat([pd.DataFrame(columns=silence._COLUMNS), *p.handleInputRows(KEY, iter([rows]), Clock(now))])
    return list(zip(found["type"], found["stale_since_us"], found["detected_at_us"]))


def test_each_accepted_payment_moves_the_only_timer():
    p = silence_processor(False)
    heard(p, now=1_000)
    assert p.handle.timers == {61_000}
    heard(p, now=11_000)
    assert p.handle.timers == {71_000}
    rows = list(p.handleExpiredTimer(KEY, Clock(), Clock(71_000)))
    assert list(rows[0]["type"]) == ["feed_stale"] and list(rows[0]["stale_since_us"]) == [11 * SECOND]
    assert heard(p, now=100_000) == [("feed_recovered", 11 * SECOND, 100 * SECOND)]


def test_stretches_bound_silences():
    """Silences between stretches, in any order of arrival within a batch, and one still open."""
    p = silence_processor(True)
    found = heard(p, (130 * SECOND, 150 * SECOND), (0, 50 * SECOND), now=180_000)
    assert found == [("feed_stale", 50 * SECOND, 110 * SECOND), ("feed_recovered", 50 * SECOND, 130 * SECOND)]
    assert p.handle.timers == {240_000}  # the limit is at 210 s; payments up to there are known at 240 s
    assert heard(p, (210 * SECOND, 211 * SECOND), now=240_000) == []  # 60 seconds sharp are no silence
    assert heard(p, (272 * SECOND, 272 * SECOND), now=420_000) == [
        ("feed_stale", 211 * SECOND, 271 * SECOND), ("feed_recovered", 211 * SECOND, 272 * SECOND), ("feed_stale", 272 * SECOND, 332 * SECOND)
    ]
    assert p.handle.timers == set()
    assert list(p.handleInputRows((None, None), iter([]), Clock())) == []  # ticks
