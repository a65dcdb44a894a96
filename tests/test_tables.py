from datetime import date, timedelta
from pathlib import Path

import pytest
from conftest import utc
from helpers import START, payments, thresholds
from pyspark.sql import functions as F

from cashtide import schemas as S
from cashtide.operators import feeds, merges, pending
from cashtide.operators import thresholds as T
from cashtide.plans import maintenance, panels
from cashtide.sources import tables, workspace
from cashtide.sources.tables import VersionedTable, jdbc_options, load_pending_file, load_table
from cashtide.streaming import jobs

PENDING = S.TABLES["pending_payments"]


def row(name, status="PENDING", due=1.0, age=0.0, amount=10, direction="DEBIT"):
    from decimal import Decimal

    return (
        name, "GBP", "RTGS-GBP-001", Decimal(amount), direction, "RTGS", "HSBC",
        START + timedelta(hours=due), status, START - timedelta(hours=age),
    )


def table(spark, *rows):
    return spark.createDataFrame(list(rows), PENDING)


def test_refresh_pending(spark):
    current = table(
        spark,
        row("due", due=-0.1, age=1),
        row("due-old", due=-0.1, age=30),
        row("later", due=1),
        row("closed-old", "CANCELLED", age=25),
        row("closed", "FAILED", age=23),
        row("waiting-old", due=3, age=48),
    )
    incoming = table(spark, row("later", due=9), row("new", due=-1), row("new", due=5), row("closed-old"))
    snapshot, summary = pending.refresh_pending(current, incoming, START, ["expected_settlement_time"])
    rows = {r["payment_id"]: r["status"] for r in snapshot.collect()}
    # A row inserted past due stays pending until the next run; a purged id blocks its own reinsertion.
    assert rows == {"due": "SETTLED", "later": "PENDING", "closed": "FAILED", "waiting-old": "PENDING", "new": "PENDING"}
    assert summary.first().asDict() == {"generated": 4, "inserted": 1, "expired": 2, "deleted": 2}
    kept = snapshot.where("payment_id IN ('later', 'new')").collect()
    assert {(r["payment_id"], (r["expected_settlement_time"] - START.replace(tzinfo=None)).total_seconds()) for r in kept} == {("later", 3600), ("new", -3600)}


def test_single_steps_agree_with_the_refresh(spark):
    current = table(spark, row("due", due=-1, age=30), row("later"))
    stepped = pending.purge(pending.expire(current, START), START)
    snapshot, _ = pending.refresh_pending(current, table(spark), START)
    assert sorted(stepped.collect()) == sorted(snapshot.collect())


def test_queue_limits_and_bounds(spark):
    rows = [row(f"p{i:03}", due=i / 60, amount=i + 1, direction="DEBIT" if i % 2 else "CREDIT") for i in range(130)]
    queue = panels.pending_queue(table(spark, *rows), START).collect()
    assert [r["payment_id"] for r in queue] == [f"p{i:03}" for i in range(50)]
    assert pending.due_soon(table(spark, *rows), START).count() == 121  # both ends included
    top = [r["payment_id"] for r in pending.largest_outbound(table(spark, *rows), START).collect()]
    assert top == [f"p{i:03}" for i in range(119, 99, -2)]


def test_pending_file(spark, tmp_path):
    table(spark, row("a"), row("b")).write.option("header", "true").csv(str(tmp_path / "csv"))
    loaded = load_pending_file(spark, str(tmp_path / "csv"))
    assert loaded.schema == PENDING and sorted(r["payment_id"] for r in loaded.collect()) == ["a", "b"]


def test_load_table(spark, tmp_path):
    table(spark, row("a")).write.parquet(str(tmp_path / "pending_payments"))
    assert load_table(spark, "pending_payments", str(tmp_path)).count() == 1
    with pytest.raises(ValueError):
        load_table(spark, "nothing", str(tmp_path))
    assert jdbc_options("jdbc:x", "t", "u", "p") == {"url": "jdbc:x", "dbtable": "t", "user": "u", "password": "p"}


def test_versions_are_read_before_their_batch(spark, tmp_path):
    schema = spark.createDataFrame([], "k STRING, v BIGINT").schema
    versions = VersionedTable(spark, str(tmp_path / "t"), schema, keep=2)
    assert versions.read().count() == 0
    for n in range(5):
        versions.write(spark.createDataFrame([("a", n)], schema), n)
    assert versions.read().first()["v"] == 4 and versions.read(before=4).first()["v"] == 3
    assert versions.versions() == [2, 3, 4]


def test_merges(spark):
    target = spark.createDataFrame([("a", 1), ("b", 1)], "k STRING, v INT")
    batch = spark.createDataFrame([("b", 2), ("b", 3), ("c", 4)], "k STRING, v INT")
    assert sorted(map(tuple, merges.upsert(target, batch, ["k"], ["v"]).collect())) == [("a", 1), ("b", 3), ("c", 4)]
    assert sorted(map(tuple, merges.insert_ignore(target, batch, ["k"], ["v"]).collect())) == [("a", 1), ("b", 1), ("c", 4)]
    assert [r["k"] for r in merges.new_rows(batch, target, ["k"]).collect()] == ["c"]


def test_publish_thresholds(spark):
    current = thresholds(spark, [(0, 100, 10)])
    updates = thresholds(spark, [(1, 200, 20), (2, 50, 50), (3, 40, 50), (4, 300, 30)]).withColumn("currency", F.lit("gbp"))
    messages, table, refused = T.publish_updates(updates, current)
    assert [(r["warning_cents"], r["currency"]) for r in table.collect()] == [(30_000, "GBP")]
    assert messages.count() == 2 and {r["key"] for r in messages.collect()} == {"GBP:RTGS-GBP-001"}
    assert {r["error"] for r in refused.collect()} == {"warning must be above critical"}


def test_decode_threshold_messages(spark):
    texts = [
        '{"currency": "JPY", "settlement_account": "NOSTRO-JPY-001", "warning_threshold": 1e10, "critical_threshold": 2000000000.0}',
        '{"settlement_account": "X", "warning_threshold": 2, "critical_threshold": 1}',
        '{"currency": "GBP", "warning_threshold": 2, "critical_threshold": 1}',
        '{"currency": "GBP", "settlement_account": "X", "critical_threshold": 1}',
        '{"currency": "GBP", "settlement_account": "X", "warning_threshold": "many", "critical_threshold": 1}',
        "no json",
    ]
    df = T.decode_updates(spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "raw STRING, seq BIGINT"), "seq")
    errors = {r["seq"]: r["error"] for r in df.collect()}
    assert errors == {0: None, 1: "missing currency", 2: "missing settlement_account", 3: None, 4: "threshold is not numeric", 5: "missing currency"}
    good = {r["seq"]: r for r in T.accepted(df).collect()}
    assert good[0]["warning_cents"] == 10**12 and good[3]["warning_cents"] is None


def test_scheduled_jobs_can_be_repeated(spark, tmp_path):
    output = jobs.Output(str(tmp_path))
    for run, as_of in ((1, START), (1, START), (2, START + timedelta(hours=2))):
        summary = maintenance.refresh_pending(spark, table(spark, row("a", due=1), row("b", due=5)), as_of, output, run)
    assert summary.first().asDict() == {"generated": 2, "inserted": 0, "expired": 1, "deleted": 0}
    for run in (1, 1, 2):
        updates = thresholds(spark, [(run, 100 * run, 10), (run, 5, 5)])
        refused = maintenance.publish_thresholds(spark, updates, output, run)
    assert refused.count() == 1
    state = VersionedTable(spark, output.table("thresholds_state"), S.THRESHOLD).read()
    assert [r["warning_cents"] for r in state.collect()] == [20_000]
    assert tables.read_batches(spark, output.table("topics/thresholds")).count() == 2


def test_feed_health_keeps_the_latest_event(spark):
    df = payments(spark, [1, 1], step=10)
    newer = feeds.rail_health(df, START + timedelta(seconds=20))
    older = feeds.rail_health(df.where("seq = 0"), START + timedelta(seconds=30)).where("rail = 'RTGS'")
    merged = {r["rail"]: r for r in feeds.update_feed_health(newer, older).collect()}
    naive = START.replace(tzinfo=None)
    assert merged["RTGS"]["last_event_time"] == naive + timedelta(seconds=10)
    assert merged["RTGS"]["last_check_time"] == naive + timedelta(seconds=30) and not merged["RTGS"]["is_stale"]
    later = feeds.stale_at(feeds.update_feed_health(newer, older), F.lit(START + timedelta(seconds=71)))
    assert {r["rail"]: r["is_stale"] for r in later.collect()} == {"RTGS": True, "CHAPS": True, "INTERNAL": True}


class _Session:
    """A session without spark.checkpoint.dir."""

    def __init__(self, master):
        self.conf = {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": master})


def test_shared_folder():
    local = _Session("local[2]")
    assert workspace.shared_dir(local) == workspace.shared_dir(local)
    with pytest.raises(RuntimeError):
        workspace.shared_dir(_Session("spark://host:7077"))
    local.conf["spark.checkpoint.dir"] = "hdfs://shared/x"
    assert workspace.new_path(local, "t").startswith("hdfs://shared/x/t-")


def test_parts_are_merged_pruned_by_day_and_replayed(spark, tmp_path, monkeypatch):
    """Forty batches over four days: few parts, only the asked days are read, replays change nothing."""
    monkeypatch.setattr(tables, "FAN", 4)
    folder, schema = str(tmp_path / "t"), spark.createDataFrame([], "at TIMESTAMP, n INT").schema

    def write(number, value=None):
        day = utc("2026-04-01T12:00:00") + timedelta(days=number // 10)
        rows = [] if number == 7 else [(day, number if value is None else value)]
        tables.write_batch(spark.createDataFrame(rows, schema).coalesce(1), folder, number, "at")

    for number in range(40):
        write(number)
        if number in (14, 39):
            write(number)  # a replay

    def found(**kwargs):
        return sorted(r.n for r in tables.read_batches(spark, folder, schema, **kwargs).collect())

    assert found() == [n for n in range(40) if n != 7]
    live = [name for name, *_ in tables._Parts(spark, folder).live()]
    assert len(live) <= 3 * 4 and len(list((tmp_path / "t/_parts").glob("[0-9]*.json"))) == tables.KEEP
    on_disk = [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("stored_part=")]
    assert len(on_disk) <= len(live) + tables.FAN + tables.KEEP
    second = (date(2026, 4, 2), date(2026, 4, 2))
    assert found(days=second) == list(range(10, 20))
    pruned = tables.read_batches(spark, folder, schema, days=second)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_day" in plan
    assert {f.split("event_day=")[1][:10] for f in pruned.inputFiles()} >= {"2026-04-02"}
    write(39, value=-1)  # the last batch again, with other rows
    assert found() == [-1, *[n for n in range(39) if n != 7]]
    assert tables.read_batches(spark, str(tmp_path / "none"), schema).count() == 0


def test_scratch_tables_are_deleted(spark):
    with workspace.scratch(spark):
        inner = workspace.materialize(spark.range(3), "inner")
        path = inner.inputFiles()[0]
        assert Path(path.removeprefix("file://")).exists()
    assert not Path(path.removeprefix("file://")).exists()
    kept = workspace.materialize(spark.range(3), "kept")
    assert kept.count() == 3
