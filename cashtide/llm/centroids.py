"""Centroid clustering of integer vectors with scalar lookup tables.

Vectors are scaled and floored to integers, so all sums and distances are exact.  In a round every task
tabulates, for each dimension, the squared difference of each integer that occurs there to each
centroid; the distances of its vectors are then gathers from these tables and sums over the dimensions,
all in NumPy.  A table has a row per integer that occurs in a batch of vectors, so its size is bounded by
the batch.  A task sends its sums per centroid and dimension, not its vectors; what reaches the driver in a
round is one number per centroid and dimension.

The integer vectors are stored in the shared folder once and read in every round.  A lost executor repeats
its own tasks only.

Defined cases: vectors that are null, of another length, or with a null, NaN or infinite component are left
out; a component beyond 2**25 stops the job with an error, since squared distances would not fit a long;
equal identifiers start in the order of their components; vectors without an identifier are clustered
but never start a centroid; fewer vectors than centroids give fewer centroids; ties go to the smaller
number; a centroid without vectors stays where it is; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashtide.sources.workspace import materialize

DIMENSIONS = 64
CENTROIDS = 16
ROUNDS = 3
SCALE = 64
SEED = "1:"
LARGEST = 1 << 25

CLUSTERED_SQL = """
WITH kept AS (
  SELECT vec_id, [CAST(FLOOR(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings
  WHERE LEN(embedding) = 64 AND LEN([x FOR x IN embedding IF x IS NOT NULL AND ISFINITE(x)]) = 64),
numbered AS (SELECT *, ROW_NUMBER() OVER () AS row FROM kept),
parts AS (SELECT row, UNNEST(RANGE(1, 65)) AS d, UNNEST(q) AS v FROM numbered),
start AS (
  SELECT ROW_NUMBER() OVER (ORDER BY SHA256('1:' || vec_id), q) - 1 AS c, q
  FROM kept WHERE vec_id IS NOT NULL ORDER BY c LIMIT 16),
c0 AS (SELECT c, UNNEST(RANGE(1, 65)) AS d, UNNEST(q) AS v FROM start)"""
for _round in range(1, ROUNDS + 2):
    _before = f"c{_round - 1}"
    CLUSTERED_SQL += f""",
near{_round} AS (
  SELECT row, c, SUM((p.v - c.v) * (p.v - c.v)) AS distance FROM parts p JOIN {_before} c USING (d) GROUP BY row, c
  QUALIFY ROW_NUMBER() OVER (PARTITION BY row ORDER BY distance, c) = 1)"""
    if _round <= ROUNDS:
        CLUSTERED_SQL += f""",
moved{_round} AS (
  SELECT c, d, CAST(FLOOR(CAST(SUM(v) AS DOUBLE) / COUNT(*)) AS BIGINT) AS v FROM near{_round} JOIN parts USING (row) GROUP BY c, d),
c{_round} AS (SELECT c, d, COALESCE(m.v, b.v) AS v FROM {_before} b LEFT JOIN moved{_round} m USING (c, d))"""
CLUSTERED_SQL += f""",
digests AS (SELECT c, SHA256(STRING_AGG(CAST(v AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(SUM(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(SUM(distance) OVER () AS BIGINT) AS inertia,
       centroid_sha256
FROM near{ROUNDS + 1} JOIN numbered USING (row) JOIN digests USING (c)"""


def integer_vectors(vectors: DataFrame, key: str, vector: str, dimensions: int, scale: int) -> DataFrame:
    """id and q (integers) of the vectors that are whole."""
    values = F.col(vector).cast("array<double>")
    whole = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    floored = F.transform(values, lambda x: F.floor(x * scale))
    largest = F.array_max(F.transform(values, lambda x: F.abs(x * scale)))
    fits = F.when(largest < LARGEST, floored.cast("array<int>")).otherwise(F.raise_error(F.lit("a component is too large")).cast("array<int>"))
    return vectors.where((F.size(values) == dimensions) & F.coalesce(whole, F.lit(False))).select(F.col(key).alias("id"), fits.alias("q"))


def _matrix(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    return batch.column("q").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def nearest(q: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of every row and its squared distance, from a table for each dimension."""
    distances = np.zeros((len(q), len(centroids)), dtype=np.int64)
    for d in range(q.shape[1]):
        occurring, at = np.unique(q[:, d], return_inverse=True)
        table = (occurring[:, None].astype(np.int64) - centroids[None, :, d]) ** 2
        distances += table[at]
    found = distances.argmin(axis=1)  # the first of equal ones
    return found, distances[np.arange(len(q)), found]


def _summed(centroids: np.ndarray):
    """Per task: the number of vectors and the sums of their components, for each centroid that has some."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, dimensions = centroids.shape
        totals, sizes = np.zeros((count, dimensions), dtype=np.int64), np.zeros(count, dtype=np.int64)
        for batch in batches:
            q = _matrix(batch, dimensions)
            found, _ = nearest(q, centroids)
            for c in np.unique(found):
                members = q[found == c]
                totals[c] += members.sum(axis=0, dtype=np.int64)
                sizes[c] += len(members)
        held = np.flatnonzero(sizes)
        columns = {
            "cluster": np.repeat(held, dimensions).astype(np.int32),
            "dimension": np.tile(np.arange(dimensions, dtype=np.int32), len(held)),
            "total": totals[held].ravel(),
            "vectors": np.repeat(sizes[held], dimensions),
        }
        yield pa.RecordBatch.from_pydict(columns)

    return run


def _assigned(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, distance = nearest(_matrix(batch, centroids.shape[1]), centroids)
            columns = [batch.column("id"), pa.array(found.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "cluster", "distance"])

    return run


def moved(stored: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    sums = stored.select("q").mapInArrow(_summed(centroids), "cluster int, dimension int, total long, vectors long")
    rows = sums.groupBy("cluster", "dimension").agg(F.sum("total").alias("total"), F.sum("vectors").alias("vectors")).collect()
    after = centroids.copy()
    for r in rows:  # one for each centroid and dimension at most
        after[r.cluster, r.dimension] = r.total // r.vectors
    return after


def clustered(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    dimensions: int = DIMENSIONS,
    count: int = CENTROIDS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: str = SEED,
) -> DataFrame:
    """``key``, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every whole vector."""
    spark = vectors.sparkSession
    stored = materialize(integer_vectors(vectors, key, vector, dimensions, scale), "vectors")
    rank = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256)
    first = stored.where("id IS NOT NULL").orderBy(rank, "q").limit(count).collect()
    kind = stored.schema["id"].dataType.simpleString()
    if not first:
        if stored.isEmpty():
            return _described(stored.select("id").withColumns({"cluster": F.lit(0), "distance": F.lit(0).cast("long")}), [], key)
        raise ValueError("no vector has an identifier to start from")
    centroids = np.array([r.q for r in first], dtype=np.int64)
    for _ in range(rounds):
        centroids = moved(stored, centroids)
    found = stored.mapInArrow(_assigned(centroids), f"id {kind}, cluster int, distance long")
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    return _described(materialize(found, "assigned"), digests, key)


def _described(found: DataFrame, digests: list[str], key: str) -> DataFrame:
    spark = found.sparkSession
    per = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # one row a centroid
    inertia = sum(r.cluster_inertia for r in per)
    rows = [(r.cluster, r.cluster_inertia, inertia, digests[r.cluster]) for r in per]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = found.join(F.broadcast(facts), "cluster")
    return joined.select(F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
