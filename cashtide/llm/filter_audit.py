"""Filter interaction audit: what each filter removes, in every order of the filters, per part of a corpus.

Every document has a failure mask, one bit per filter.  Documents are counted per part and mask (map-side,
so a part sends at most 2^filters rows a task), and each part's counts become a decision diagram: one level
per filter in the order they are applied, a pass and a fail edge from every node, and the number of
documents below as the weight of a node.  Equal nodes are shared.  Changing the order of two neighbouring
filters is a swap of two adjacent levels, which rebuilds the nodes of these levels only; the orders are
visited so that each differs from the one before by one such swap.  In every order the path along the
pass edges from the root yields the steps: the weight of the pass child is kept, that of the fail child
removed.  What a filter removes in first place is all that fails it, and in last place what fails nothing
else; the sum over all orders is its Shapley share, times the number of orders.

The filters: A under 200 words, B under half of the words distinct, C over 2 in 100 characters capital
letters, D one of six signs, E the text of a document with a smaller identifier.  Texts are read once; their
digests and masks are stored in the shared folder, and only those are joined (``lookups``).

Defined cases: null texts are empty; a null source is the part '' (with sources that are empty); documents
without an identifier neither fail E nor make others fail; rows that repeat the least identifier of a text
pass E; of several labels of a document one with quality 1 makes it good, one with toxic 1 toxic; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashtide.llm.lookups import looked_up
from cashtide.sources.workspace import materialize

FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT = 50  # in a hundred words
MOST_CAPITALS = 2  # in a hundred characters
SIGNS = "#$%&*|"
_BLANKS = r"[\x20\x09-\x0D]+"

STEPS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)

AUDIT_SQL = """
WITH texts AS (SELECT doc_id, COALESCE(source, '') AS part, COALESCE(text, '') AS text FROM documents),
words AS (
  SELECT *, REGEXP_EXTRACT_ALL(text, '[^\\x20\\x09-\\x0D]+') AS w,
         LENGTH(text) - LENGTH(REGEXP_REPLACE(text, '[A-Z]', '', 'g')) AS capitals,
         COALESCE(doc_id > MIN(doc_id) OVER (PARTITION BY text), FALSE) AS is_copy
  FROM texts),
marks AS (SELECT doc_id, MAX(quality) AS quality, MAX(toxic) AS toxic FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, CAST(LEN(w) < 200 AS INTEGER) + 2 * CAST(100 * LEN(LIST_DISTINCT(w)) < 50 * LEN(w) AS INTEGER)
         + 4 * CAST(100 * capitals > 2 * LENGTH(text) AS INTEGER) + 8 * CAST(REGEXP_MATCHES(text, '[#$%&*|]') AS INTEGER)
         + 16 * CAST(is_copy AS INTEGER) AS mask,
         COALESCE(quality = 1, FALSE) AS good, COALESCE(toxic = 1, FALSE) AS toxic
  FROM words LEFT JOIN marks USING (doc_id)),
counts AS (
  SELECT part, mask, COUNT(*) AS docs, COUNT(*) FILTER (WHERE good) AS good, COUNT(*) FILTER (WHERE toxic) AS toxic
  FROM masks GROUP BY part, mask),
letters AS (SELECT UNNEST(['A', 'B', 'C', 'D', 'E']) AS f, UNNEST([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a JOIN letters b ON a.f <> b.f JOIN letters c ON c.f NOT IN (a.f, b.f)
  JOIN letters d ON d.f NOT IN (a.f, b.f, c.f) JOIN letters e ON e.f NOT IN (a.f, b.f, c.f, d.f)),
steps AS (
  SELECT filter_order, CAST(s AS INTEGER) AS step, bits[s] AS bit, CAST(LIST_SUM(bits[1:s]) AS INTEGER) AS so_far,
         CAST(COALESCE(LIST_SUM(bits[1:s - 1]), 0) AS INTEGER) AS before
  FROM orders, UNNEST([1, 2, 3, 4, 5]) AS t(s)),
found AS (
  SELECT part, filter_order, step, bit,
         SUM(CASE WHEN mask & so_far = 0 THEN docs ELSE 0 END) AS kept,
         SUM(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN docs ELSE 0 END) AS removed,
         SUM(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN docs ELSE 0 END) AS redundant,
         SUM(CASE WHEN mask = bit THEN docs ELSE 0 END) AS unique_fails,
         SUM(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
         SUM(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM counts, steps GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(SUM(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM found"""


# ---- masks ----------------------------------------------------------------------------------


def text_failures(text: Column) -> list[Column]:
    """The failure conditions of the filters that look at the text alone (A to D)."""
    words = F.filter(F.split(text, _BLANKS), lambda w: w != "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return [
        F.size(words) < LEAST_WORDS,
        F.size(F.array_distinct(words)) * 100 < F.size(words) * LEAST_DISTINCT,
        capitals.cast("long") * 100 > F.length(text) * MOST_CAPITALS,
        F.regexp_like(text, F.lit("[" + "".join("\\" + s for s in SIGNS) + "]")),
    ]


def failure_masks(docs: DataFrame) -> DataFrame:
    """doc_id, part and mask (bit i for filter i) of every document."""
    text = F.coalesce("text", F.lit(""))
    bits = [F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(text_failures(text))]
    rows = docs.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("part"),
        sum(bits[1:], bits[0]).alias("mask"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("sha"),
    )
    rows = materialize(rows, "masks")
    copies = rows.groupBy("sha").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    found = looked_up(rows, materialize(copies, "copies"), ["sha"], "copies", rows.count())
    is_copy = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    return found.select("doc_id", "part", (F.col("mask") + F.when(is_copy, 1 << 4).otherwise(0)).alias("mask"))


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, docs, good, toxic."""
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("is_good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("is_toxic")
    )
    return masks.join(marks, "doc_id", "left").groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("docs"), F.count_if("is_good").alias("good"), F.count_if("is_toxic").alias("toxic")
    )


# ---- decision diagrams ------------------------------------------------------------------------


class Diagram:
    """A count-weighted decision diagram; a node is (weight, pass child, fail child)."""

    def __init__(self, counts: dict[int, tuple[int, ...]], filters: int, width: int = 3):
        """``counts``: the weight (a tuple of ``width`` numbers) of every failure mask that occurs."""
        self.order = list(range(filters))
        self._shared: dict[tuple, tuple] = {}
        none = (0,) * width

        def built(level: int, mask: int) -> tuple:
            if level == filters:
                return self._node(counts.get(mask, none))
            return self._parent(built(level + 1, mask), built(level + 1, mask | 1 << level))

        self.root = built(0, 0)

    def _node(self, weight: tuple, passed: tuple | None = None, failed: tuple | None = None) -> tuple:
        return self._shared.setdefault((weight, id(passed), id(failed)), (weight, passed, failed))

    def _parent(self, passed: tuple, failed: tuple) -> tuple:
        return self._node(tuple(a + b for a, b in zip(passed[0], failed[0])), passed, failed)

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the level below it."""
        done: dict[int, tuple] = {}

        def swapped(node: tuple, depth: int) -> tuple:
            if id(node) not in done:
                (_, first, second) = node
                if depth:
                    done[id(node)] = self._parent(swapped(first, depth - 1), swapped(second, depth - 1))
                else:
                    done[id(node)] = self._parent(self._parent(first[1], second[1]), self._parent(first[2], second[2]))
            return done[id(node)]

        self.root = swapped(self.root, level)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def path(self) -> list[tuple[tuple, tuple]]:
        """(weight kept, weight removed) at every level of the all-pass path."""
        found, node = [], self.root
        for _ in self.order:
            found.append((node[1][0], node[2][0]))
            node = node[1]
        return found


def plain_changes(count: int) -> Iterator[int]:
    """Positions whose swap with the next one visits all orders of ``count`` things, each once."""
    if count < 2:
        return
    down = True
    for inner in [*plain_changes(count - 1), None]:
        yield from range(count - 2, -1, -1) if down else range(count - 1)
        if inner is not None:
            yield inner + 1 if down else inner
        down = not down


def audit(counts: dict[int, tuple[int, int, int]], names: str = FILTERS) -> list[tuple]:
    """(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of all orders."""
    diagram = Diagram(counts, len(names))
    paths = {tuple(diagram.order): diagram.path()}
    for level in plain_changes(len(names)):
        diagram.swap(level)
        paths[tuple(diagram.order)] = diagram.path()
    first, last, shares = {}, {}, dict.fromkeys(range(len(names)), 0)
    for order, path in paths.items():
        first[order[0]], last[order[-1]] = path[0][1][0], path[-1][1][0]
        for name, (_, removed) in zip(order, path):
            shares[name] += removed[0]
    rows = []
    for order in permutations(range(len(names))):
        text = "".join(names[i] for i in order)
        for step, (name, (kept, removed)) in enumerate(zip(order, paths[order]), start=1):
            rows.append((text, step, kept[0], removed[0], first[name] - removed[0], last[name], removed[1], removed[2], shares[name]))
    return rows


def _audited(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [part.split()[0] for part in STEPS.split(", ")]
    for batch in batches:
        for part, counts in zip(batch["part"], batch["counts"]):
            rows = audit({c["mask"]: (c["docs"], c["good"], c["toxic"]) for c in counts})
            yield pd.DataFrame([(part, *row) for row in rows], columns=columns)


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The steps of every order of the filters, per part."""
    counts = mask_counts(failure_masks(docs), labels)
    # At most 2^filters rows a part.
    per_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "docs", "good", "toxic")).alias("counts"))
    return per_part.mapInPandas(_audited, STEPS)
