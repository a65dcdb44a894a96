"""Running values over hot keys: ordered blocks instead of one task per key.

There are few accounts and one of them may hold a third of all payments, so
``Window.partitionBy(account)`` would put a third of the data in one task.  Here each key's
ordered rows are cut into blocks.  A first pass sums each block, a prefix over the block totals
gives every block its opening values, and the row-level window is partitioned by (key, block).

Blocks are stretches of event time, as wide as ``max_rows`` allows.  If even the narrowest
stretch of some key holds more, the rows of that key are range-partitioned on (key, order) instead:
Spark then picks the bounds from the data, so ties in time are split too.  The number of ranges is
bounded; beyond it ranges grow, and sorting spills.

With ``ranges`` all rows are range-partitioned from the start: for the batches of a stream, where passes
over the data cost more than a shuffle saves, and where one key may bring nearly all rows.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cashtide.functions.money import wide_sum
from cashtide.schemas import TOTAL_CENTS
from cashtide.sources.workspace import materialize

BLOCK = "_block"
MAX_BLOCK_ROWS = 2_000_000
MAX_RANGES = 20_000
_WIDTHS = [86_400, 3_600, 300, 60]  # seconds, each a multiple of the last
_ROWS = "_rows"
_FIRST_TIME = "_first_time"


@dataclass
class BlockScan:
    """Running values to compute for every row, in (key, order) sequence.

    sums     name -> LONG column: running total including the row, DECIMAL(28,0)
    latest   name -> column: last non-null value up to and including the row
    count    name of the running row count, counting rows where ``counted`` holds
    next_time name of the column with the following row's time, NULL for the last row
    """

    sums: dict[str, Column]
    latest: dict[str, Column] | None = None
    count: str | None = None
    counted: Column | None = None
    next_time: str | None = None


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    scan: BlockScan,
    max_rows: int = MAX_BLOCK_ROWS,
    opening: DataFrame | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Add the columns of ``scan`` to ``df``; ``order`` starts with a TIMESTAMP and must be total.

    ``opening`` holds at most one row per key with values to start from, under the names of
    ``scan.sums``, ``scan.count`` and ``scan.latest``.
    """
    latest = scan.latest or {}
    sums = dict(scan.sums)
    if scan.count:
        counted = F.lit(True) if scan.counted is None else scan.counted
        sums[scan.count] = F.when(counted, 1).otherwise(0).cast("long")

    work = df
    for name, value in {**sums, **latest}.items():
        work = work.withColumn(f"_in_{name}", value)

    if ranges:
        blocked, totals = _ranged(work, keys, order, sums, ranges)
    else:
        blocked, totals = _cut(work, keys, order, sums, max_rows)
    openings = _block_openings(blocked, totals, keys, order, sums, latest, scan.next_time, opening)

    in_block = Window.partitionBy(*keys, BLOCK).orderBy(*order)
    so_far = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = blocked
    for name in sums:
        rows = rows.withColumn(f"_run_{name}", F.sum(f"_in_{name}").over(so_far))
    for name in latest:
        rows = rows.withColumn(f"_run_{name}", F.last(f"_in_{name}", ignorenulls=True).over(so_far))
    if scan.next_time:
        rows = rows.withColumn("_run_next", F.lead(order[0]).over(in_block))

    joined = rows.join(openings, [*keys, BLOCK])
    out = [F.col(c) for c in df.columns]
    for name in sums:
        # Within a block LONG sums suffice; counts always fit.
        run = F.col(f"_run_{name}")
        if name == scan.count:
            total = F.col(f"_open_{name}").cast("long") + run
        else:
            total = (F.col(f"_open_{name}") + run.cast("decimal(19,0)")).cast(TOTAL_CENTS)
        out.append(total.alias(name))
    for name in latest:
        out.append(F.coalesce(f"_run_{name}", f"_open_{name}").alias(name))
    if scan.next_time:
        out.append(F.coalesce("_run_next", "_open_next").alias(scan.next_time))
    return joined.select(*out)


def _totals(rows, keys, order, sums):
    """Totals of each block; a block may turn out to be too hot, so its sum must not overflow either."""
    agg = [wide_sum(F.col(f"_in_{s}")).alias(s) for s in sums]
    return rows.groupBy(*keys, BLOCK).agg(F.count(F.lit(1)).alias(_ROWS), F.min(order[0]).alias(_FIRST_TIME), *agg)


def _ranged(work, keys, order, sums, ranges):
    """Rows in ranges of (key, order), stored: block numbers must be the same wherever they are read."""
    cut = work.repartitionByRange(ranges, *keys, *order).withColumn(BLOCK, F.spark_partition_id().cast("long"))
    stored = materialize(cut, "ranged")
    return stored, _totals(stored, keys, order, sums)


def _cut(work, keys, order, sums, max_rows):
    """Rows with a block column, and the block totals (a small stored table)."""

    def totals_of(rows, name):
        return materialize(_totals(rows, keys, order, sums), name)

    def time_block(width):
        return F.floor(F.unix_seconds(F.col(order[0])) / F.lit(width)).cast("long")

    base = _WIDTHS[-1]
    fine = totals_of(work.withColumn(BLOCK, time_block(base)), "block-totals")
    hot = fine.groupBy(*keys).agg(F.max(_ROWS).alias("_most"), F.sum(_ROWS).alias("_all")).where(F.col("_most") > max_rows)
    hot = materialize(hot, "hot-keys")
    in_hot = hot.agg(F.sum("_all")).first()[0]
    if in_hot:
        # Only keys that need it are cut in ranges; the others keep their blocks of time.
        parts = max(2, min(MAX_RANGES, -(-4 * in_hot // max_rows)))
        stored, totals = _ranged(work.join(hot.select(*keys), keys, "left_semi"), keys, order, sums, parts)
        totals = materialize(totals, "range-totals")
        work = work.join(hot.select(*keys), keys, "left_anti")
        fine = fine.join(hot.select(*keys), keys, "left_anti")
    for width in _WIDTHS:
        coarse = fine.withColumn(BLOCK, F.floor(F.col(BLOCK) * base / F.lit(width)).cast("long"))
        coarse = coarse.groupBy(*keys, BLOCK).agg(
            F.sum(_ROWS).alias(_ROWS),
            F.min(_FIRST_TIME).alias(_FIRST_TIME),
            *[F.sum(s).cast(TOTAL_CENTS).alias(s) for s in sums],
        )
        largest = coarse.agg(F.max(_ROWS)).first()[0]
        if (largest or 0) <= max_rows:
            break
    blocked = work.withColumn(BLOCK, time_block(width))
    if in_hot:
        return blocked.unionByName(stored.select(*blocked.columns)), coarse.unionByName(totals.select(*coarse.columns))
    return blocked, coarse


def _block_openings(blocked, totals, keys, order, sums, latest, next_time, opening):
    """One row per (key, block) with the values in force just before the block's first row."""
    by_block = Window.partitionBy(*keys).orderBy(BLOCK)
    before = by_block.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast(TOTAL_CENTS)

    for name in latest:
        # Only rows that carry a value are read and sorted here.
        last = (
            blocked.where(F.col(f"_in_{name}").isNotNull())
            .groupBy(*keys, BLOCK)
            .agg(F.max_by(F.col(f"_in_{name}"), F.struct(*order)).alias(f"_last_{name}"))
        )
        totals = totals.join(last, [*keys, BLOCK], "left")

    cols = [*keys, BLOCK]
    for name in sums:
        cols.append(
            F.coalesce(F.sum(name).over(before).cast(TOTAL_CENTS), zero).alias(f"_open_{name}")
        )
    for name in latest:
        cols.append(F.last(f"_last_{name}", ignorenulls=True).over(before).alias(f"_open_{name}"))
    if next_time:
        cols.append(F.lead(_FIRST_TIME).over(by_block).alias("_open_next"))
    openings = totals.select(*cols)

    if opening is not None:
        start = opening.select(*keys, *[F.col(n).alias(f"_start_{n}") for n in [*sums, *latest]])
        openings = openings.join(start, keys, "left")
        for name in sums:
            initial = F.coalesce(F.col(f"_start_{name}").cast(TOTAL_CENTS), zero)
            openings = openings.withColumn(f"_open_{name}", (F.col(f"_open_{name}") + initial).cast(TOTAL_CENTS))
        for name in latest:
            openings = openings.withColumn(f"_open_{name}", F.coalesce(f"_open_{name}", f"_start_{name}"))
        openings = openings.drop(*[f"_start_{n}" for n in [*sums, *latest]])
    return openings
