"""Exact duplicates by a tree merge of sorted digest runs.

Every text becomes an entry: its SHA-256, a second hash and its length, the identifier of its row, and
a count of one.  The entries of each scan partition are a run.  Runs meet in rounds along a hypercube, the
binomial tree with every partition as a root: in a round the ``WAYS`` partitions whose numbers differ in
one digit exchange, each takes the entries whose digest has its own digit at that place, and merges the
runs it gets in digest order.  With ``WAYS`` a power of two a round does the work of log2(WAYS) binomial
rounds in one shuffle.  Merging joins entries of one text: the identifier that stays is the largest (or
smallest), counts add up.  After the last round every partition holds a sorted run of its own digests, so
no partition ever holds all of them.

Entries are merged only if the digest, the second hash and the length agree at that level, so the
identifier that stays is verified again at every one.

A text that very many documents share has one entry in a run from the first merge on, and meets at most
``WAYS`` runs in a round.  Rows then look their group up (``lookups``).  Only built-in column functions are
used; texts are read once and never shuffled.  Lost executors: entries are stored in the shared folder
before the first round, and the merged runs after the last.

Defined cases: null texts are empty ones; null identifiers lose against every other; rows that repeat
identifier and text are one group of which one row stays; a group of null identifiers has a null
``keep_id`` and keeps one row; an empty table gives an empty result; other columns are ignored, or kept by
``without_duplicates``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashtide.llm.lookups import looked_up
from cashtide.sources.workspace import materialize

WAYS = 8  # runs merged at once
RUN_ROWS = 16_384  # entries of a run at the end, while the number of runs is not at its bound
MOST_ROUNDS = 5  # at most WAYS**MOST_ROUNDS runs; beyond it runs get longer, and sorting spills
TEXT = ["sha", "check", "n_bytes"]  # what entries of one text have in common

DEDUPLICATED_SQL = """
WITH texts AS (SELECT doc_id, COALESCE(text, '') AS text FROM documents)
SELECT doc_id, MAX(doc_id) OVER same AS keep_id, COUNT(*) OVER same AS group_size,
       doc_id = MAX(doc_id) OVER same AS kept, SHA256(text) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY text)"""


def _unchanged(text: Column) -> Column:
    return text


def entries(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    normalize: Callable[[Column], Column] = _unchanged,
    row: Column | None = None,
) -> DataFrame:
    """One entry per row: row (a number of its own), id, run (its scan partition) and the digest columns."""
    whole = normalize(F.coalesce(F.col(text), F.lit(""))).cast("binary")
    return docs.select(
        (F.monotonically_increasing_id() if row is None else row).alias("row"),
        F.spark_partition_id().alias("run"),
        F.col(key).alias("id"),
        F.unhex(F.sha2(whole, 256)).alias("sha"),
        F.xxhash64(whole).alias("check"),
        F.octet_length(whole).cast("long").alias("n_bytes"),
    )


def rounds_for(count: int, ways: int = WAYS) -> int:
    """Rounds after which a run has about ``RUN_ROWS`` entries."""
    rounds = 1
    while rounds < MOST_ROUNDS and ways**rounds * RUN_ROWS < count:
        rounds += 1
    return rounds


def _digit(number: Column, place: int, ways: int) -> Column:
    return F.pmod(F.floor(number / F.lit(ways**place)).cast("int"), F.lit(ways))


def merged_runs(found: DataFrame, rounds: int, ways: int = WAYS, keep: str = "largest") -> DataFrame:
    """(run, sha, check, n_bytes, best, copies): one row per different text, in sorted runs.

    ``best`` is a struct of the identifier and the row that stays.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep the largest or the smallest, not {keep!r}")
    runs = ways**rounds
    known = F.col("id").isNotNull() if keep == "largest" else F.col("id").isNull()
    chosen = F.max if keep == "largest" else F.min
    place = F.conv(F.hex(F.substring("sha", 1, 3)), 16, 10).cast("int")  # 24 bits of the digest
    work = found.select(
        F.pmod("run", F.lit(runs)).alias("run"), *TEXT, F.struct(known.alias("known"), "id", "row").alias("best"), F.lit(1).cast("long").alias("copies")
    )
    for turn in range(rounds):
        moved = (_digit(place, turn, ways) - _digit(F.col("run"), turn, ways)) * F.lit(ways**turn)
        sent = work.withColumn("run", F.col("run") + moved).repartitionById(runs, F.col("run"))
        # A struct has no fixed-width buffer: the entries of a partition are sorted and merged in order.
        work = sent.sortWithinPartitions("run", *TEXT).groupBy("run", *TEXT).agg(chosen("best").alias("best"), F.sum("copies").alias("copies"))
    return work


def duplicate_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    normalize: Callable[[Column], Column] = _unchanged,
    keep: str = "largest",
    ways: int = WAYS,
    row: Column | None = None,
) -> DataFrame:
    """One row per document: row, id, keep_id, group_size, kept, text_sha256."""
    found = materialize(entries(docs, key, text, normalize, row), "entries")
    count = found.count()
    runs = merged_runs(found, rounds_for(count, ways), ways, keep).where("copies > 1").drop("run")
    groups = materialize(runs, "digest-runs")
    rows = looked_up(found.drop("run"), groups, TEXT, "copies", count)
    alone = F.col("copies").isNull()
    return rows.select(
        "row",
        "id",
        F.when(alone, F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("copies", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("best.row") == F.col("row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every document."""
    return duplicate_groups(docs).drop("row").withColumnRenamed("id", "doc_id")


def without_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "largest") -> DataFrame:
    """The rows that stay, with all their columns, whatever these are called.

    Rows are numbered and stored first: the numbers must be the same wherever they are read.
    """
    names = {name: f"_{i}" for i, name in enumerate(docs.columns)}
    plain = docs.withColumnsRenamed(names).withColumn("row", F.monotonically_increasing_id())
    numbered = materialize(plain, "numbered")
    groups = duplicate_groups(numbered, names[key], names[text], keep=keep, row=F.col("row"))
    left = numbered.join(groups.where(~F.col("kept")).select("row"), "row", "left_anti")
    return left.select(*[F.col(new).alias(old) for old, new in names.items()])
