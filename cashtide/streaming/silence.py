"""Silent feeds: an account without accepted payments for longer than the time limit, and its recovery.

Only the first and last payment of each stretch of time can bound a silence that is longer than the
stretch.  So payments are first reduced to one row per account and stretch, and the keyed processor sees
these: an account that brings nearly all payments sends it no more rows than any other.

Two clocks.  By event time a native windowed aggregation reduces the payments and hands on each stretch
once the watermark has closed it; timers follow the watermark, to the end of the stretch that a limit falls
in, so the events depend on the data only, however they are cut into batches.  Ticks (rows with a time but no
account) move the watermark on when no account speaks.  By processing time the rows of a task are reduced
per batch, and timers follow the machine's clock: for live monitoring, where silence means that nothing
arrives.
"""

import sys
from collections.abc import Iterator
from math import ceil

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from cashtide import schemas as S
from cashtide.functions.keys import account_key
from cashtide.functions.messages import json_message
from cashtide.sources.tables import write_batch
from cashtide.streaming.jobs import Output, configure, start

EVENT_TABLE = T.StructType(
    [T.StructField("type", T.StringType()), T.StructField("key", T.StringType())]
    + [T.StructField(name, T.TimestampType()) for name in ("stale_since", "detected_at")]
)
_FOUND = "currency STRING, settlement_account STRING, type STRING, stale_since_us BIGINT, detected_at_us BIGINT"
_COLUMNS = [part.split()[0] for part in _FOUND.split(", ")]
STALE, RECOVERED = "feed_stale", "feed_recovered"


class SilenceProcessor(StatefulProcessor):
    """State of an account: its last payment, whether its silence was reported, and one timer."""

    def __init__(self, stale_us: int, by_event: bool):
        self.stale_us, self.by_event = stale_us, by_event

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at_us BIGINT, reported BOOLEAN")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if not key[1]:  # ticks
            return
        stretches = [r for part in rows for r in zip(part["first_us"].tolist(), part["last_us"].tolist())]
        if self.by_event:
            now_us = timerValues.getCurrentWatermarkInMs() * 1000 // self.stale_us * self.stale_us
        else:
            now_us = timerValues.getCurrentProcessingTimeInMs() * 1000
            stretches = [(now_us, now_us)]
        found = []
        last, reported = self.last.get() if self.last.exists() else (None, False)
        for first, end in sorted(stretches):
            if last is not None and (reported or first - last > self.stale_us):
                if not reported:
                    found.append((STALE, last, last + self.stale_us))
                found.append((RECOVERED, last, first))
                reported = False
            last = end if last is None else max(last, end)
        if self.by_event and last + self.stale_us < now_us:
            found.append((STALE, last, last + self.stale_us))
            reported = True
        self.last.update((last, reported))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if not reported:
            self.handle.registerTimer(self._known_ms(last + self.stale_us))
        if found:
            yield self._events(key, found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, reported = self.last.get()
        if not reported:
            self.last.update((last, True))
            yield self._events(key, [(STALE, last, last + self.stale_us)])

    def _known_ms(self, limit_us: int) -> int:
        """When a silence is known: by event time all payments up to its limit are in closed stretches."""
        if self.by_event:
            limit_us = ceil(limit_us / self.stale_us) * self.stale_us
        return ceil(limit_us / 1000)

    def _events(self, key, found) -> pd.DataFrame:
        return pd.DataFrame([(key[0], key[1], *event) for event in found], columns=_COLUMNS)


def stretches(payments: DataFrame, stale_seconds: float) -> DataFrame:
    """First and last payment of each account and stretch of event time, once the watermark closed it."""
    rows = payments.select(*S.ACCOUNT_KEY, "event_time")
    window = F.window("event_time", f"{int(stale_seconds * 1000)} milliseconds").alias("stretch")
    ends = F.unix_micros(F.min("event_time")).alias("first_us"), F.unix_micros(F.max("event_time")).alias("last_us")
    return rows.withWatermark("event_time", S.WATERMARK_DELAY).groupBy(*S.ACCOUNT_KEY, window).agg(*ends)


def _present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each account of a batch of rows."""
    for batch in batches:
        yield batch.drop_duplicates().assign(first_us=0, last_us=0)


def silences(payments: DataFrame, stale_seconds: float = S.STALE_FEED_SECONDS, clock: str = "event") -> DataFrame:
    """A stream of (currency, settlement_account, type, stale_since_us, detected_at_us)."""
    if clock not in ("event", "processing"):
        raise ValueError(f"no clock {clock!r}")
    by_event = clock == "event"
    if by_event:
        reduced = stretches(payments, stale_seconds)
    else:
        reduced = payments.select(*S.ACCOUNT_KEY).mapInPandas(_present, "currency STRING, settlement_account STRING, first_us BIGINT, last_us BIGINT")
    processor = SilenceProcessor(int(stale_seconds * 1_000_000), by_event)
    mode = "EventTime" if by_event else "ProcessingTime"
    return reduced.groupBy(*S.ACCOUNT_KEY).transformWithStateInPandas(processor, outputStructType=_FOUND, outputMode="Append", timeMode=mode)


def start_silences(
    payments: DataFrame,
    output: Output,
    available_now: bool = False,
    stale_seconds: float = S.STALE_FEED_SECONDS,
    clock: str = "event",
) -> StreamingQuery:
    """Stale and recovered events to the table ``feed_events`` and the feed-health topic.

    ``payments`` are accepted ones: a stream over the engine's ledger, or any without copies.
    """
    configure(payments.sparkSession)
    found = silences(payments, stale_seconds, clock)
    writer = found.writeStream.outputMode("append").foreachBatch(lambda batch, batch_id: _write(batch, batch_id, output))
    return start(writer, "silences", output, available_now)


def _write(batch: DataFrame, batch_id: int, output: Output) -> None:
    batch = batch.persist()
    try:
        if batch.isEmpty():  # timers make batches run without input
            return
        key = account_key(*[F.col(c) for c in S.ACCOUNT_KEY]).alias("key")
        times = [F.timestamp_micros(f"{c}_us").alias(c) for c in ("stale_since", "detected_at")]
        events = batch.select("type", key, *times)
        write_batch(events, output.table("feed_events"), batch_id, "detected_at")
        fields = ["type", "key", *[F.unix_millis(c).alias(f"{c}_ts") for c in ("stale_since", "detected_at")]]
        messages = events.select(F.lit(S.FEED_HEALTH_TOPIC).alias("topic"), "key", json_message(fields).alias("value"))
        output.publish(messages, "feed_events", batch_id)
    finally:
        batch.unpersist()


def gaps(events: DataFrame) -> DataFrame:
    """Silences with their end: key, stale_since, detected_at, recovered_at (NULL while one lasts)."""
    stale = events.where(F.col("type") == STALE).select("key", "stale_since", "detected_at")
    ends = events.where(F.col("type") == RECOVERED).select("key", "stale_since", F.col("detected_at").alias("recovered_at"))
    return stale.join(ends, ["key", "stale_since"], "left")


# Executors need not have this package installed: the processor travels with the query.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
