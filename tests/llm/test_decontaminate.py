import random

import duckdb
from conftest import SMALL
from odd_rows import ODD, docs_of

from cashtide.llm import decontaminate as dc


def distance(item, text):
    before = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        row = [i]
        for j, b in enumerate(text, 1):
            row.append(min(before[j - 1] + (a != b), before[j] + 1, row[-1] + 1))
        before = row
    return min(before)


def test_bit_parallel_distance():
    random.seed(0)
    for _ in range(1_500):
        item = "".join(random.choice("abc") for _ in range(random.randint(1, 12)))
        text = "".join(random.choice("abc") for _ in range(random.randint(0, 30)))
        assert dc.least_distance(dc.masks_of(item), len(item), text) == distance(item, text)


def test_matches_equal_brute_force():
    random.seed(4)
    items = tuple((i, "".join(random.choice("abcd ") for _ in range(60)).strip() or "x") for i in range(4))
    items = tuple((i, dc.normalized(t)) for i, t in items)
    matcher, hits = dc.Matcher(items, 0.1), 0
    for _ in range(150):
        _, item = random.choice(items)
        text = list("".join(random.choice("abcd") for _ in range(20)) + item + "".join(random.choice("abcd") for _ in range(20)))
        for _ in range(random.randint(0, 9)):
            at = random.randrange(len(text))
            text[at : at + random.randint(0, 1)] = random.choice(["", "a", "c"])
        plain = dc.normalized("".join(text))
        wanted = [i for i, t in items if distance(t, plain) <= int(len(t) * 0.1)]
        assert matcher.find(plain) == wanted
        hits += len(wanted)
    assert hits > 50


def test_table_equals_containment_where_passages_are_exact(spark):
    docs, bench = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    found = {(r.doc_id, i) for r in dc.leaks(docs, bench).collect() for i in r["items"]}
    exact = duckdb.sql(
        f"SELECT doc_id, item_id FROM '{SMALL}/documents.parquet' d, '{SMALL}/benchmark.parquet' b WHERE contains(d.text, b.text)"
    ).fetchall()
    assert exact and set(exact) <= found
    assert dc.without_leaks(docs, bench).count() == docs.count() - len({d for d, _ in found})


def test_short_items_match_exactly_between_word_borders():
    matcher = dc.Matcher(((1, "red fox"), (2, "人工智能"), (3, "x")), dc.ERROR_RATE)
    found = lambda text: matcher.find(text)
    assert found("A Red, fox!") == [1] and found("red fox") == [1] and found("x red foxes; hundred fox, red  fox x") == [1, 3]
    assert found("hundred fox") == found("red foxes") == found("red box") == found("xx") == []
    assert found("学习人工智能的书") == [2] and found("人工知能") == []


def test_blocks_and_odd_rows(spark):
    text = "the quick brown fox jumps over the lazy dog and runs away from it"
    bench = spark.createDataFrame([(1, text), (1, text), (2, None), (None, text), (3, "short"), (4, text[::-1])], "item_id long, text string")
    assert [[i for i, _ in b] for b in dc.blocks(bench, block_chars=10)] == [[1], [3, 4]]
    docs = docs_of(spark, [*ODD, (9, "X " + text.upper() + "!"), (9, "X " + text.upper() + "!"), (8, text[:40])])
    found = dc.leaks(docs, bench).collect()
    assert sorted(tuple(r["items"]) for r in found if r.contaminated) == [(1,), (1,)] and len(found) == len(ODD) + 3
    kept = dc.without_leaks(docs, bench)
    assert kept.count() == len(ODD) + 1 and kept.columns == docs.columns
    assert dc.leaks(docs, bench.limit(0)).where("contaminated").count() == 0 and dc.leaks(docs.limit(0), bench).count() == 0
