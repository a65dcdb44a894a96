import hashlib

from conftest import SMALL
from odd_rows import docs_of
from pyspark.sql import functions as F

from cashtide.llm import fingerprints as fp


def check(docs, rows):
    found = {}
    for r in fp.fingerprinted(docs).collect():
        found.setdefault(r.doc_id, []).append(r)
    order = sorted(((i, t or "") for i, t in rows), key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        lines = [{p for p in t.split("\n") if p} for t in (text, edited, after)]
        near = [len(lines[0] & x) / len(lines[0] | x) if lines[0] | x else 1.0 for x in lines[1:]]
        wanted = (len(text), hashlib.sha256(edited.encode()).hexdigest(), *(round(n, 9) for n in near))
        assert wanted in {(r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in found[i]}
    assert sum(map(len, found.values())) == len(rows)
    return found


def test_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = check(docs, rows)
    by_text = {}
    for i, text in rows:
        by_text.setdefault(text, set()).add(found[i][0].fingerprint)
    assert all(len(prints) == 1 for prints in by_text.values()) and len({p for s in by_text.values() for p in s}) == len(by_text)


def test_odd_rows_and_many_paragraphs(spark, monkeypatch):
    monkeypatch.setattr(fp, "RANGE_ROWS", 3)  # several ranges
    many = "\n".join(f"line {i}" for i in range(3_000))
    rows = [(1, None), (2, ""), (3, "é\nb\n\nb"), (3, "é\nb\n\nb"), (3, "a"), (7, many), (8, many + "\nmore"), (None, "n\nm"), (None, None), (9, "x" * 50_000)]
    check(docs_of(spark, rows), rows)
    one = [(5, "only\none")]
    check(docs_of(spark, one), one)
    assert fp.fingerprinted(docs_of(spark, [])).count() == 0


def test_peeling_recovers_or_refuses(spark):
    sets = spark.range(60).select(
        "id",
        F.transform(F.sequence(F.lit(1).cast("long"), F.lit(20).cast("long")), lambda x: F.xxhash64(x, "id")).alias("a"),
        F.transform(F.sequence(F.lit(1).cast("long"), F.col("id") + 1), lambda x: F.xxhash64(x, "id")).alias("b"),
    )
    peel = fp.peeled(fp.difference(fp.sketch(F.col("a"), fp.SECOND), fp.sketch(F.col("b"), fp.SECOND)), fp.SECOND)
    rows = sets.select("id", peel.alias("apart")).collect()
    assert all(r.apart in (None, abs(r.id + 1 - 20)) for r in rows)
    assert sum(r.apart is None for r in rows if r.id < 40) <= 3
