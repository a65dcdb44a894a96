"""Connected components of an edge table by alternating large and small stars.

Every round links the neighbours of each node to the least of them; the number of rounds grows with
the logarithm of the longest path.  Repeated edges go at the end of a round only, one shuffle less.  Sums and minima are combined in the tasks before each shuffle and
joins carry no hint, so a node with very many neighbours is split by the planner.  Each round is
stored in the shared folder, which cuts the lineage.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashtide.sources.workspace import materialize


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root): the least node of its component, for every node of an edge."""
    rows = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).where("u <> v").distinct()
    rows = materialize(rows, "edges")
    state = _state(rows)
    while state[0]:
        rows = materialize(_small_star(_large_star(rows)), "edges")
        before, state = state, _state(rows)
        if state == before:
            break
    members = rows.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return members.unionByName(rows.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def extended(roots: DataFrame, edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) of components with further edges: only roots are linked again, not all their nodes.

    The roots are read several times and should be stored.
    """
    own = lambda key, name: roots.select(F.col("node").alias(key), F.col("root").alias(name))
    ends = edges.select(left, right).join(own(left, "x"), left, "left").join(own(right, "y"), right, "left")
    ends = ends.select(F.coalesce("x", left).alias("x"), F.coalesce("y", right).alias("y"))
    joined = materialize(components(ends, "x", "y"), "joined")
    moved = roots.join(joined.toDF("root", "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return moved.unionByName(joined.join(roots.select("node"), "node", "left_anti"))
