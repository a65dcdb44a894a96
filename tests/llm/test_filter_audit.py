import random
from itertools import permutations

import pytest
from compare import differences, duck
from conftest import SMALL
from odd_rows import docs_of

from cashtide.llm import filter_audit as fa
from cashtide.llm import queries


@pytest.fixture(scope="module")
def con():
    con = duck(SMALL)
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')")
    return con


def test_table_equals_sql(spark, con):
    assert differences(con, queries.QUERIES["op12_filter_audit"](spark, SMALL), queries.ORACLE["op12_filter_audit"]) == ""


def brute(counts, names):
    rows, n = [], len(names)
    for order in permutations(range(n)):
        left = dict(counts)
        for step, f in enumerate(order, start=1):
            gone = {m: w for m, w in left.items() if m >> f & 1}
            left = {m: w for m, w in left.items() if not m >> f & 1}
            fails = sum(w[0] for m, w in counts.items() if m >> f & 1)
            removed = [sum(w[k] for w in gone.values()) for k in range(3)]
            alone = counts.get(1 << f, (0, 0, 0))[0]
            rows.append(["".join(names[i] for i in order), step, sum(w[0] for w in left.values()), removed[0], fails - removed[0], alone, removed[1], removed[2]])
    shares = {}
    for r in rows:
        shares[r[0][r[1] - 1]] = shares.get(r[0][r[1] - 1], 0) + r[3]
    return [(*r, shares[r[0][r[1] - 1]]) for r in rows]


@pytest.mark.parametrize("names", ["A", "AB", "ABCD", "ABCDE"])
def test_diagrams_equal_brute_force(names):
    random.seed(len(names))
    for held in (0, 1, 3, 2 ** len(names)):
        masks = random.sample(range(2 ** len(names)), min(held, 2 ** len(names)))
        counts = {m: tuple(random.choice([0, 1, 1, 7]) for _ in range(3)) for m in masks}
        assert fa.audit(counts, names) == brute(counts, names)


def test_swaps_visit_every_order_once():
    for count in range(1, 6):
        order = list(range(count))
        seen = {tuple(order)}
        swaps = list(fa.plain_changes(count))
        for at in swaps:
            order[at], order[at + 1] = order[at + 1], order[at]
            seen.add(tuple(order))
        assert len(seen) == len(swaps) + 1 == len(list(permutations(range(count))))


def test_equal_nodes_are_shared():
    diagram = fa.Diagram({m: (1, 0, 0) for m in range(32)}, 5)
    nodes, level = set(), {id(diagram.root): diagram.root}
    while level:
        nodes |= set(level)
        level = {id(c): c for n in level.values() for c in n[1:] if c}
    assert len(nodes) == 6


def test_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, None), (2, None, 1), (None, 1, 1), (9, 1, 1)], "doc_id long, quality int, toxic int")
    rows = [(1, None), (2, ""), (2, ""), (None, ""), (None, None), (3, "# A"), (3, "# A"), (4, "# A"), (5, "word " * 40_000), (6, " ".join(f"w{i}" for i in range(300)))]
    masks = sorted((str(r.doc_id), r.mask) for r in fa.failure_masks(docs_of(spark, rows)).collect())
    # A 1, B 2, C 4, D 8, E 16; null identifiers neither are copies nor make copies.
    assert masks == sorted(
        [("1", 1), ("2", 17), ("2", 17), ("None", 1), ("None", 1), ("3", 1 + 4 + 8), ("3", 1 + 4 + 8), ("4", 1 + 4 + 8 + 16), ("5", 2), ("6", 0)]
    )
    docs = docs_of(spark, rows).withColumn("mask", fa.F.lit("m")).withColumn("source", fa.F.when(fa.F.col("doc_id") < 3, ""))
    found = fa.interactions(docs, labels).where("filter_order = 'ABCDE'").collect()
    assert sorted({r.part for r in found}) == [""]
    first = {r.step: r for r in found}
    assert (first[1].kept, first[1].removed, first[1].good_lost, first[1].toxic_lost) == (2, 8, 1, 2)
    assert (first[5].kept, first[5].removed, first[5].redundant, first[5].unique_fails) == (1, 0, 3, 0)
    assert fa.interactions(docs.limit(0), labels).count() == 0
    assert fa.interactions(docs, labels.limit(0)).count() == 600
