import random
from datetime import timedelta

import pytest
from conftest import SMALL
from helpers import MILLION, START, payments, thresholds
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cashtide import schemas as S
from cashtide.operators import alerts, feeds, flows, positions
from cashtide.operators.blocks import BlockScan, running
from cashtide.operators.thresholds import with_latest_bounds
from cashtide.sources import driver_tables as D


def ledger_of(spark, signed, **kwargs):
    return positions.position_ledger(payments(spark, signed), **kwargs).orderBy("seq").collect()


def alerts_of(spark, signed, warning, critical):
    history = thresholds(spark, [(-1, warning, critical)])
    found = alerts.alerts(positions.position_ledger(payments(spark, signed), history))
    return found.orderBy("triggered_at").collect()


def test_mixed_sequence(spark):
    rows = ledger_of(spark, [100 * MILLION, -20 * MILLION, -5 * MILLION, 10 * MILLION])
    assert [int(r["balance_cents"]) // 100 for r in rows] == [100 * MILLION, 80 * MILLION, 75 * MILLION, 85 * MILLION]


def test_totals_and_negative_balance(spark):
    rows = ledger_of(spark, [10 * MILLION, 5 * MILLION, -7 * MILLION, -30 * MILLION])
    last = rows[-1]
    assert int(last["inbound_cents"]) == 1500 * MILLION
    assert int(last["outbound_cents"]) == 3700 * MILLION
    assert last["balance_cents"] < 0 and last["payment_count"] == 4


def test_current_position(spark):
    row = positions.current_positions(payments(spark, [5, 5, 5], ids=["first-id", "x", "second-id"])).first()
    assert (row["payment_count"], row["last_payment_id"]) == (3, "second-id")


def test_same_instant_takes_the_higher_sequence(spark):
    row = positions.current_positions(payments(spark, [1, 2, 3], step=0)).first()
    assert row["last_payment_id"] == "p-2"


@pytest.mark.parametrize(
    "signed, expected",
    [
        ([5000 * MILLION, -100 * MILLION], []),
        ([1000 * MILLION], [("WARNING", 100_000 * MILLION)]),
        ([200 * MILLION], [("CRITICAL", 30_000 * MILLION)]),
        ([2000 * MILLION], []),  # strictly below
        ([500 * MILLION], [("WARNING", 150_000 * MILLION)]),
    ],
)
def test_alerts(spark, signed, expected):
    rows = alerts_of(spark, signed, 2000 * MILLION, 500 * MILLION)
    assert [(r["alert_type"], int(r["breach_cents"])) for r in rows] == expected


def test_no_thresholds_no_alert(spark):
    other = thresholds(spark, [(0, 10, 5)], account=("USD", "NOSTRO-USD-001"))
    assert alerts.alerts(positions.position_ledger(payments(spark, [1]), other)).count() == 0


def test_missing_bound_does_not_alert(spark):
    assert alerts_of(spark, [100], None, 50) == []
    assert [r["alert_type"] for r in alerts_of(spark, [10], None, 50)] == ["CRITICAL"]


def test_changed_thresholds_apply_from_their_instant(spark):
    history = thresholds(spark, [(-5, 2000, 500), (1, 500, 100), (3, None, None)])
    rows = alerts.alerts(positions.position_ledger(payments(spark, [1000, 0, -600, 0, 0]), history))
    found = [(r["payment_id"], r["alert_type"]) for r in rows.orderBy("triggered_at").collect()]
    # 1000 < 2000 before the change; at the change 1000 >= 500; then 400 < 500; then no bounds.
    assert found == [("p-0", "WARNING"), ("p-2", "WARNING")]


def test_day_reset(spark):
    df = payments(spark, [1, 2, 4, 8], step=12 * 3600)
    rows = positions.position_ledger(df, reset="day").orderBy("seq").collect()
    assert [int(r["balance_cents"]) for r in rows] == [100, 300, 400, 1200]


@pytest.mark.parametrize("max_rows", [2_000_000, 400, 60, 7])
def test_blocks_equal_one_window_at_every_width(spark, max_rows):
    """Day, hour and range blocks give what a single window per account gives."""
    df = D.payments(D.table(spark, SMALL, "events"))
    whole = Window.partitionBy(*S.ACCOUNT_KEY).orderBy(*S.PAYMENT_ORDER).rowsBetween(Window.unboundedPreceding, 0)
    signed = F.when(F.col("direction") == "CREDIT", F.col("amount_cents")).otherwise(-F.col("amount_cents"))
    expected = {r[0]: r[1] for r in df.select("payment_id", F.sum(signed).over(whole)).collect()}
    ledger = positions.position_ledger(df, max_rows=max_rows)
    assert {r["payment_id"]: int(r["balance_cents"]) for r in ledger.collect()} == expected


def test_hot_instant_is_split(spark):
    """Every row of one account at one instant: no stretch of time can split it, ranges do."""
    n = 500
    df = payments(spark, [1] * n, step=0)
    rows = running(
        df, S.ACCOUNT_KEY, S.PAYMENT_ORDER,
        BlockScan(sums={"total": F.col("amount_cents")}, count="n", next_time="next",
                  latest={"odd": F.when(F.col("seq") % 2 == 1, F.col("seq"))}),
        max_rows=50,
    ).orderBy("seq").collect()
    assert [r["n"] for r in rows] == list(range(1, n + 1))
    assert [int(r["total"]) for r in rows] == [100 * i for i in range(1, n + 1)]
    assert [r["odd"] for r in rows] == [None] + [i if i % 2 else i - 1 for i in range(1, n)]
    assert rows[-1]["next"] is None and all(r["next"] is not None for r in rows[:-1])


def test_opening_values(spark):
    df = payments(spark, [10, 20])
    opening = spark.createDataFrame([("GBP", "RTGS-GBP-001", 500, 100, 3)], "currency STRING, settlement_account STRING, inbound_cents BIGINT, outbound_cents BIGINT, payment_count BIGINT")
    rows = positions.position_ledger(df, opening=opening).orderBy("seq").collect()
    assert [(int(r["balance_cents"]), r["payment_count"]) for r in rows] == [(1400, 4), (3400, 5)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-500, 500).filter(bool), min_size=1, max_size=40), st.integers(2, 30))
def test_ledger_ends_at_the_position_and_flows_add_up(spark, signed, max_rows):
    step = random.Random(len(signed)).choice([0, 1, 200, 4000])
    df = payments(spark, signed, step=step)
    last = positions.position_ledger(df, max_rows=max_rows).orderBy(F.desc("seq")).first()
    position = positions.current_positions(df).first()
    flow = flows.flow_summary(df).agg(F.sum("net_cents"), F.sum("payment_count")).first()
    assert last["balance_cents"] == position["balance_cents"] == flow[0] == sum(signed) * 100
    assert last["payment_count"] == position["payment_count"] == flow[1] == len(signed)


def test_flow_totals_do_not_overflow(spark):
    big = spark.range(40).select(
        F.lit("GBP").alias("currency"), F.lit("A").alias("settlement_account"),
        F.lit(9_000_000_000_000_000_000).alias("amount_cents"), F.lit("CREDIT").alias("direction"),
        F.lit(START).alias("event_time"),
    )
    assert int(flows.flow_summary(big).first()["inbound_cents"]) == 40 * 9_000_000_000_000_000_000


def test_feed_gap_golden(spark):
    df = payments(spark, [1, 1, 1], step=61)
    as_of = START + timedelta(seconds=2 * 61 + 60)
    rows = feeds.feed_gaps(df, as_of, 60).orderBy("stale_since").collect()
    assert len(rows) == 2  # the last gap is exactly 60 s, not longer
    assert (rows[0]["detected_at"] - rows[0]["stale_since"]).total_seconds() == 60
    assert rows[0]["recovered_at"] == rows[1]["stale_since"]
    assert feeds.feed_gaps(df, as_of + timedelta(seconds=1), 60).where("recovered_at IS NULL").count() == 1


def test_rail_health_lists_silent_rails(spark):
    rows = {r["rail"]: r for r in feeds.rail_health(payments(spark, [1, 1]), START + timedelta(seconds=30)).collect()}
    assert set(rows) == set(S.RAILS)
    assert (rows["RTGS"]["is_stale"], rows["RTGS"]["event_count_1min"]) == (False, 2)
    assert rows["CHAPS"]["is_stale"] and rows["CHAPS"]["last_event_time"] is None


def test_business_hours(spark):
    from cashtide.functions.times import in_business_hours

    df = spark.createDataFrame([("09:00",), ("07:00",), ("18:00",), ("03:00",), ("18:01",)], "t STRING")
    at = F.concat(F.lit("2026-04-01 "), "t").cast("timestamp")
    assert [r[0] for r in df.select(in_business_hours(at)).collect()] == [True, True, True, False, False]


def test_latest_bounds_left_join(spark):
    ledger = positions.position_ledger(payments(spark, [1]))
    assert with_latest_bounds(ledger, thresholds(spark, [])).first()["warning_cents"] is None
