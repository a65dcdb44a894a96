"""Small hand-made inputs."""

import json
from datetime import timedelta

from conftest import utc

from cashtide import schemas as S

START = utc("2026-04-01T09:15:00")
MILLION = 1_000_000


def message(**changes):
    """A valid payment message; a field set to ... is left out."""
    fields = {
        "event_time": "2026-04-01T09:15:00.000Z",
        "payment_id": "p-1",
        "rail": "RTGS",
        "direction": "DEBIT",
        "amount": 22_750_000.5,
        "currency": "GBP",
        "settlement_account": "RTGS-GBP-001",
        "counterparty": "Sample Bank",
    } | changes
    return json.dumps({k: v for k, v in fields.items() if v is not ...})


def feed(spark, texts):
    rows = [(t, i, START + timedelta(seconds=i)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "raw STRING, seq BIGINT, arrived TIMESTAMP")


def payments(spark, signed, ids=None, account=("GBP", "RTGS-GBP-001"), step=1):
    """Payments of one account from signed amounts in whole units."""
    rows = [
        (
            ids[i] if ids else f"p-{i}",
            *account,
            abs(amount) * 100,
            "CREDIT" if amount >= 0 else "DEBIT",
            "RTGS",
            None,
            START + timedelta(seconds=i * step),
            i,
        )
        for i, amount in enumerate(signed)
    ]
    return spark.createDataFrame(rows, S.PAYMENT)


def thresholds(spark, changes, account=("GBP", "RTGS-GBP-001")):
    """Updates of one account: (seconds after start, warning, critical) in whole units."""
    rows = [
        (
            *account,
            None if w is None else w * 100,
            None if c is None else c * 100,
            START + timedelta(seconds=at),
            "desk",
            i,
        )
        for i, (at, w, c) in enumerate(changes)
    ]
    return spark.createDataFrame(rows, S.THRESHOLD)
