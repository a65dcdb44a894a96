import hashlib

import pytest
from compare import differences, duck
from conftest import SMALL
from odd_rows import ODD, docs_of
from pyspark.sql import functions as F

from cashtide.llm import exact_dedup as ed
from cashtide.llm import queries


@pytest.fixture(scope="module")
def con():
    con = duck(SMALL)
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')")
    return con


def test_table_equals_sql(spark, con):
    assert differences(con, queries.QUERIES["op11_exact_dedup"](spark, SMALL), queries.ORACLE["op11_exact_dedup"]) == ""


def brute(rows, keep):
    groups = {}
    for i, text in rows:
        groups.setdefault(text or "", []).append(i)
    chosen = {}
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        chosen[text] = (max(known) if keep == "largest" else min(known)) if known else None
    return sorted(
        (str(i), str(chosen[t or ""]), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows
    )


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("ways", [2, 4])
def test_odd_rows_over_many_rounds(spark, monkeypatch, keep, ways):
    """Runs of two entries: four rounds and more, a hot text in all of them, ties, nulls."""
    monkeypatch.setattr(ed, "RUN_ROWS", 2)
    rows = ODD + [(100 + i, "hot" if i % 3 else f"text {i}") for i in range(90)]
    docs = docs_of(spark, rows).repartition(13)
    found = ed.duplicate_groups(docs, keep=keep, ways=ways).collect()
    assert sorted((str(r.id), str(r.keep_id), r.group_size, r.text_sha256) for r in found) == brute(rows, keep)
    kept = [r for r in found if r.kept]
    assert len(kept) == len({t or "" for _, t in rows}) == len({r.text_sha256 for r in kept})
    assert all(r.id == r.keep_id for r in kept)


def test_runs_are_sorted_and_hold_their_own_digests(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 300).alias("text"))
    runs = ed.merged_runs(ed.entries(docs.repartition(7)), rounds=3, ways=2)
    per_task = runs.select("*", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("at")).collect()
    assert len(per_task) == 300 and sum(r.copies for r in per_task) == 500
    for run in {r.run for r in per_task}:
        own = sorted((r for r in per_task if r.run == run), key=lambda r: r.at)
        digests = [bytes(r.sha) for r in own]
        assert digests == sorted(digests) and len({r.task for r in own}) == 1
        assert all(int.from_bytes(d[:3], "big") % 8 == run for d in digests)


def test_normalized_texts_and_other_columns(spark):
    docs = docs_of(spark, [(1, "A b"), (2, "a B"), (3, "c")]).withColumn("sha", F.lit("x")).withColumn("row", F.lit(7))
    found = {r.id: r.keep_id for r in ed.duplicate_groups(docs, normalize=F.lower).collect()}
    assert found == {1: 2, 2: 2, 3: 3}
    repeated = docs.unionByName(docs)
    left = ed.without_duplicates(repeated)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [1, 2, 3]
    assert ed.deduplicated(docs.limit(0)).count() == 0 and ed.without_duplicates(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        ed.duplicate_groups(docs, keep="first")


def test_main_path_is_native(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    plan = ed.deduplicated(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
