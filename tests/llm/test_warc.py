import gzip
import io

import compare
import duckdb
from conftest import SMALL

from cashtide.llm import queries, warc


def test_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SMALL}/pages.parquet')")
    assert compare.differences(con, queries.QUERIES["op2_warc"](spark, SMALL), warc.ARCHIVED_SQL) == ""


def test_any_split_finds_every_record_once():
    rows = [warc.record(_row(i, "<p>" + "word%d " % i * (40 * i) + "</p>"), "2024-01-01T00:00:00Z") for i in range(12)]
    data = b"".join(rows)
    whole = list(warc.scan(io.BytesIO(data), 0, len(data)))
    assert [m for _, m in whole] == [gzip.decompress(r) for r in rows]
    for size in (1, 7, 100, 1_000):
        parts = [x for a in range(0, len(data), size) for x in warc.scan(io.BytesIO(data), a, a + size)]
        assert parts == whole


def test_chance_magic_is_passed_over():
    record = warc.record(_row(1, "x" * 3_000), "2024-01-01T00:00:00Z")
    noise = b"junk\x1f\x8b\x08junk" + gzip.compress(b"no record, only text") + warc.MAGIC
    assert [at for at, _ in warc.scan(io.BytesIO(noise + record), 0, len(noise + record))] == [len(noise)]


def _row(number, html):
    import hashlib
    from types import SimpleNamespace

    digest = hashlib.sha1(html.encode()).hexdigest()
    return SimpleNamespace(page_id=str(number), url="http://a/b c\r\nX: y", payload=html, payload_digest=digest,
                           payload_bytes=len(html.encode()), record_type="response", refers_to=None)


def test_odd_rows(spark):
    long = "é" * 800
    rows = [(1, None, None), (2, "u", ""), (3, "u", long), (4, None, long), (4, None, long), (5, "http://x\n", long), (None, "u", long), (7, "u", "x" * 999), (8, "u", "x" * 999)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")
    found = sorted(warc.archived_pages(pages).collect(), key=lambda r: (r.page_id is None, r.page_id or 0))
    assert [(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in found] == [
        (1, 0, "response", None), (2, 0, "response", None), (3, 1600, "revisit", 5), (4, 1600, "revisit", 5), (4, 1600, "revisit", 5),
        (5, 1600, "response", None), (7, 999, "response", None), (8, 999, "response", None), (None, 1600, "revisit", 5),
    ]
    assert warc.archived_pages(pages.limit(0)).count() == 0


def test_small_splits_and_archives(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    archives = warc.write_archives(warc.classified(pages), warc.new_path(spark, "warc"), archive_bytes=20_000)
    read = warc.read_archives(spark, archives, split_bytes=3_000)
    assert archives.count() > 1 and archives.agg({"records": "sum"}).first()[0] == read.count() == pages.count()
    html = {str(r.page_id): r.html for r in pages.collect()}
    assert all(r.payload.decode() == html[r.record_id[len("<urn:page:"):-1]] for r in read.collect() if r.record_type == "response")
