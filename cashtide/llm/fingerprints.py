"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A sketch has three tables of cells; every paragraph digest falls in one cell of each.  A cell keeps how
many digests it holds, their exclusive or, and the exclusive or of their check hashes.  Sketches of two
versions subtract cell by cell, so what both hold cancels; peeling then takes out cells that hold one
digest until none is left, which recovers the digests on either side.  If cells remain, the
difference was too large: the two versions are sketched again, larger.  The first enlargement has more
cells; the ones after it split the digests in ever more sections with a sketch each, so the work grows
with the paragraphs and not with their square.

From the recovered difference d and the sizes of both sets follows the likeness, the share of
paragraphs in common: (|A| + |B| - d) / (|A| + |B| + d).

Only built-in column functions are used.  The next document of each document is found without a global
sort: ids are dealt to ranges (their bounds are quantiles, a bounded list), each range gets one more
row, the first of the range after it, and a window within the range looks one row ahead.  The text is
shuffled once.

Defined cases: null texts are empty; paragraphs are the lines that are not empty, each counted once;
two texts without paragraphs have likeness 1.0; rows are ordered by descending doc_id, null ids last,
equal ids by text, so repeated rows follow each other; a single row is its own next one; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cashtide.sources.workspace import materialize

FIRST, SECOND = 4, 16  # cells of each of the three tables, at first and on the first retry
ROUNDS = 16
SPREAD = 4  # factor of sections from one retry to the next
MOST_SECTIONS = SPREAD**10
RANGE_ROWS = 2_000
MOST_RANGES = 4_096
_SHIFTS = (0, 20, 40)
_CELL = "struct<n:int,k:bigint,c:bigint>"


def digests(text: Column) -> Column:
    """The different digests of a text's paragraphs."""
    lines = F.filter(F.split(text, "\n"), lambda p: p != "")
    return F.array_distinct(F.transform(lines, lambda p: F.xxhash64(p)))


def place(digest: Column, table: int, cells: int) -> Column:
    return F.pmod(F.shiftright(digest, _SHIFTS[table]), F.lit(cells)).cast("int")


def _xor(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x))


def sketch(found: Column, cells: int) -> Column:
    """array of 3 * cells (n, k, c) of a set of digests."""

    def cell(held: Column) -> Column:
        check = _xor(F.transform(held, lambda x: F.xxhash64(x)))
        return F.struct(F.size(held).alias("n"), _xor(held).alias("k"), check.alias("c"))

    return F.concat(*(F.transform(_held(found, table, cells), cell) for table in range(3)))


def _held(found: Column, table: int, cells: int) -> Column:
    """array(cells) of the digests in each cell of one table."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(cells - 1)), lambda j: F.filter(found, lambda x: place(x, table, cells) == j)
    )


def difference(ours: Column, theirs: Column) -> Column:
    def less(a: Column, b: Column) -> Column:
        return F.struct(
            (a["n"] - b["n"]).alias("n"), a["k"].bitwiseXOR(b["k"]).alias("k"), a["c"].bitwiseXOR(b["c"]).alias("c")
        )

    return F.zip_with(ours, theirs, less)


def peeled(cells_left: Column, cells: int, rounds: int = ROUNDS) -> Column:
    """Number of digests on either side; null if cells remain."""
    start = F.struct(cells_left.cast(f"array<{_CELL}>").alias("left"), F.lit(0).alias("found"))

    def single(c: Column) -> Column:
        return (F.abs(c["n"]) == 1) & (F.xxhash64(c["k"]) == c["c"])

    def located(c: Column) -> Column:
        at = [(place(c["k"], t, cells) + t * cells).alias(f"at{t}") for t in range(3)]
        return F.struct(c["n"].alias("n"), c["k"].alias("k"), c["c"].alias("c"), *at)

    def without(c: Column, i: Column, pure: Column) -> Column:
        here = F.filter(pure, lambda p: (p["at0"] == i) | (p["at1"] == i) | (p["at2"] == i))
        return F.aggregate(
            here,
            F.struct(c["n"].alias("n"), c["k"].alias("k"), c["c"].alias("c")),
            lambda a, p: F.struct(
                (a["n"] - p["n"]).alias("n"), a["k"].bitwiseXOR(p["k"]).alias("k"), a["c"].bitwiseXOR(p["c"]).alias("c")
            ),
        )

    def step(state: Column, _: Column) -> Column:
        pure = F.array_distinct(F.transform(F.filter(state["left"], single), located))
        # The list of pure cells is needed for every cell: a one-element array names it once.
        return F.element_at(
            F.transform(
                F.array(pure),
                lambda p: F.when(F.size(p) == 0, state).otherwise(
                    F.struct(
                        F.transform(state["left"], lambda c, i: without(c, i, p)).alias("left"),
                        (state["found"] + F.size(p)).alias("found"),
                    )
                ),
            ),
            1,
        )

    def done(state: Column) -> Column:
        rest = F.exists(state["left"], lambda c: (c["n"] != 0) | (c["k"] != 0) | (c["c"] != 0))
        return F.when(~rest, state["found"])

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step, done)


def likeness(ours: Column, theirs: Column, apart: Column) -> Column:
    both = ours + theirs
    return F.when(apart.isNotNull(), F.when(both == 0, 1.0).otherwise((both - apart) / (both + apart)))


def written(cells: Column) -> Column:
    return F.array_join(F.transform(cells, lambda c: F.concat_ws(":", c["n"], F.hex(c["k"]), F.hex(c["c"]))), " ")


def with_next(docs: DataFrame) -> DataFrame:
    """Adds next_text, the text of the row after this one (descending doc_id); the last gets the first."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    count = rows.count()
    ranges = max(1, min(MOST_RANGES, -(-count // RANGE_ROWS)))
    shares = [i / ranges for i in range(1, ranges)]
    bounds = rows.agg(F.percentile_approx("doc_id", shares, 100 * ranges)).first()[0] if shares else None
    bounds = sorted(set(bounds or []))
    known = F.array(*(F.lit(b) for b in bounds)) if bounds else F.array().cast("array<long>")
    at = F.when(F.col("doc_id").isNull(), -1).otherwise(F.size(F.filter(known, lambda b: F.col("doc_id") >= b)))
    rows = rows.withColumn("range", at).withColumn("guest", F.lit(False))
    # At most one row a range; the first of each becomes a guest behind the range before it.
    heads = rows.groupBy("range").agg(F.max("doc_id").alias("head")).orderBy(F.desc("range")).collect()
    if not heads:
        return rows.select("doc_id", "text", F.lit("").alias("next_text"))
    follows = [(r["range"], heads[i - 1]["range"], r["head"]) for i, r in enumerate(heads)]
    table = docs.sparkSession.createDataFrame(follows, "own int, host int, head long")
    firsts = rows.join(F.broadcast(table), (F.col("range") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("head")))
    guests = firsts.groupBy("host", "doc_id").agg(F.min("text").alias("text"))
    guests = guests.select("doc_id", "text", F.col("host").alias("range"), F.lit(True).alias("guest"))
    order = Window.partitionBy("range").orderBy("guest", F.desc_nulls_last("doc_id"), "text")
    ahead = rows.unionByName(guests).withColumn("next_text", F.lead("text").over(order))
    return ahead.where(~F.col("guest")).select("doc_id", "text", "next_text")


def edited(text: Column, following: Column) -> Column:
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def _in_sections(pending: DataFrame, sections: int) -> DataFrame:
    """(row, pair, apart): the difference of each pair, sketched in sections; null if one failed."""
    side = lambda name, sign: F.transform(name, lambda x: F.struct(x.alias("digest"), F.lit(sign).alias("side")))
    entries = pending.select("row", "pair", F.explode(F.concat(side("ours", 0), side("theirs", 1))).alias("e"))
    section = F.pmod(F.xxhash64("e.digest", F.lit(sections)), F.lit(sections))
    per = entries.groupBy("row", "pair", section.alias("section")).agg(
        F.collect_list(F.when(F.col("e.side") == 0, F.col("e.digest"))).alias("ours"),
        F.collect_list(F.when(F.col("e.side") == 1, F.col("e.digest"))).alias("theirs"),
    )
    cells = per.select("row", "pair", difference(sketch(F.col("ours"), SECOND), sketch(F.col("theirs"), SECOND)).alias("cells"))
    apart = cells.select("row", "pair", peeled(F.col("cells"), SECOND).alias("apart"))
    whole = F.sum("apart"), F.count(F.when(F.col("apart").isNull(), 1))
    return apart.groupBy("row", "pair").agg(F.when(whole[1] == 0, whole[0]).alias("apart"))


def _retried(pending: DataFrame) -> DataFrame:
    """(row, pair, apart) of all pairs, with ever more sections; at last by comparing the sets."""
    solved, sections = None, SPREAD
    while sections <= MOST_SECTIONS:
        tried = materialize(_in_sections(pending, sections), "sketches")
        good = tried.where("apart is not null")
        solved = good if solved is None else solved.unionByName(good)
        failed = tried.where("apart is null").select("row", "pair")
        if failed.isEmpty():
            return solved
        pending, sections = pending.join(failed, ["row", "pair"]), sections * SPREAD
    apart = F.size(F.array_except("ours", "theirs")) + F.size(F.array_except("theirs", "ours"))
    return solved.unionByName(pending.select("row", "pair", apart.cast("long").alias("apart")))


def fingerprinted(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = with_next(docs).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    rows = rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        *(digests(F.col(c)).alias(name) for c, name in (("text", "own"), ("edited", "other"), ("next_text", "following"))),
    )
    sketched = rows.withColumns({f"{c}_cells": sketch(F.col(c), FIRST) for c in ("own", "other", "following")})
    near, pairs = {}, ("other", "following")
    for c in pairs:
        small = peeled(difference(F.col("own_cells"), F.col(f"{c}_cells")), FIRST)
        large = peeled(difference(sketch(F.col("own"), SECOND), sketch(F.col(c), SECOND)), SECOND)
        near[f"{c}_apart"] = F.coalesce(small, large)
    known = sketched.withColumns(near).select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "n_chars",
        "edited_sha256",
        written(F.col("own_cells")).alias("fingerprint"),
        written(F.col("other_cells")).alias("edited_fingerprint"),
        *(F.size(c).alias(f"{c}_size") for c in ("own", *pairs)),
        *near,
        *(F.when(F.col("other_apart").isNull() | F.col("following_apart").isNull(), F.col(c)).alias(c) for c in ("own", *pairs)),
    )
    known = materialize(known, "fingerprints")
    pending = None
    for c in pairs:
        part = known.where(F.col(f"{c}_apart").isNull()).select("row", F.lit(c).alias("pair"), F.col("own").alias("ours"), F.col(c).alias("theirs"))
        pending = part if pending is None else pending.unionByName(part)
    if not pending.isEmpty():
        solved = _retried(pending)
        for c in pairs:
            later = solved.where(F.col("pair") == c).select("row", F.col("apart").cast("int").alias("later"))
            known = known.join(later, "row", "left").withColumn(f"{c}_apart", F.coalesce(f"{c}_apart", "later")).drop("later")
    return known.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("own_size"), F.col("other_size"), F.col("other_apart")).alias("near_edited"),
        likeness(F.col("own_size"), F.col("following_size"), F.col("following_apart")).alias("near_next"),
    )
