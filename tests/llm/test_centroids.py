import hashlib
import math
import random

import pytest
from compare import differences, duck
from conftest import SMALL

from cashtide.llm import centroids as ce
from cashtide.llm import queries


@pytest.fixture(scope="module")
def con():
    con = duck(SMALL)
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SMALL}/embeddings.parquet')")
    return con


def test_table_equals_sql(spark, con):
    assert differences(con, queries.QUERIES["op13_centroids"](spark, SMALL), queries.ORACLE["op13_centroids"]) == ""


def brute(rows, dimensions, count, rounds, scale=64):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(x * scale) for x in v]))
    start = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None)[:count]
    cents = [q for _, q in start]

    def near(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), n) for n, c in enumerate(cents))

    for _ in range(rounds):
        members = {}
        for _, q in kept:
            members.setdefault(near(q)[1], []).append(q)
        cents = [[sum(x) // len(x) for x in zip(*members[n])] if n in members else c for n, c in enumerate(cents)]
    out = [(i, near(q)) for i, q in kept]
    per = {}
    for _, (d, n) in out:
        per[n] = per.get(n, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted((str(i), n, d, per[n], sum(per.values()), digest[n]) for i, (d, n) in out)


SCHEMA = "vec_id long, embedding array<float>, id string, q string, cluster string, distance int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "i", "q", "c", 1) for i, v in rows], SCHEMA)


def test_odd_rows_equal_brute_force(spark):
    random.seed(3)
    rows = [(i, [random.choice([-2.0, -0.26, 0.0, 0.5, 1.01]) for _ in range(4)]) for i in range(120)]
    rows += [(7, rows[3][1]), (7, rows[3][1]), (None, rows[0][1]), (200, None), (201, []), (202, [1.0, None, 0.0, 0.0]), (203, [1.0] * 3)]
    rows += [(204, [float("nan"), 0.0, 0.0, 0.0]), (205, [float("-inf"), 0.0, 0.0, 0.0]), (206, [-0.001, 0.0, 0.0, 500_000.0])]
    found = ce.clustered(vectors(spark, rows).repartition(5), dimensions=4, count=6).collect()
    ours = sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in found)
    assert ours == brute(rows, 4, 6, 3)


def test_few_vectors_and_none(spark):
    rows = [(1, [0.5, 1.0]), (2, [0.5, 1.0]), (3, [9.0, 9.0])]
    found = ce.clustered(vectors(spark, rows), dimensions=2).collect()
    ours = sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in found)
    assert ours == brute(rows, 2, 16, 3)
    empty = ce.clustered(vectors(spark, []), dimensions=2)
    assert empty.count() == 0 and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_components_that_do_not_fit_stop_the_job(spark):
    with pytest.raises(Exception, match="too large"):
        ce.clustered(vectors(spark, [(1, [1e20, 0.0])]), dimensions=2).collect()
