import random

import numpy as np
from odd_rows import ODD, REPEATED, docs_of

from cashtide.llm import order_minhash as om
from cashtide.llm.components import components, extended


def longest(x, y):
    before = [0] * (len(y) + 1)
    for a in x:
        row = [0]
        for j, b in enumerate(y, 1):
            row.append(before[j - 1] + 1 if a == b else max(before[j], row[-1]))
        before = row
    return before[-1]


def test_banded_alignment():
    random.seed(1)
    near = 0
    for _ in range(1_500):
        x = [random.randint(1, 30) for _ in range(random.randint(1, 40))]
        y = list(x)
        for _ in range(random.randint(0, 6)):
            if y and random.random() < 0.5:
                y.pop(random.randrange(len(y)))
            else:
                y.insert(random.randint(0, len(y)), random.randint(1, 30))
        matched = longest(x, y)
        wanted = matched / (len(x) + len(y) - matched) if y else 0.0
        found = om.aligned(np.array(x, np.uint64), np.array(y, np.uint64))
        assert abs(found - (wanted if wanted >= 0.8 - 1e-12 else 0.0)) < 1e-9
        near += found > 0
    assert near > 300


def test_sketches_keep_order():
    words = [f"w{i}" for i in range(60)]
    forward, backward = om.shingles([" ".join(words), " ".join(words[30:] + words[:30])])
    same = (om.sketch(forward) == om.sketch(backward)).sum()
    assert (om.sketch(forward) == om.sketch(forward.copy())).all() and same < om.SKETCHES
    assert [len(s) for s in om.shingles(["", "one", "a b c d e f", "É é"])] == [0, 1, 2, 1]


def test_classes_equal_brute_force(spark):
    random.seed(8)
    words = ["".join(random.choice("abcdefg") for _ in range(4)) for _ in range(400)]
    originals = [[random.choice(words) for _ in range(random.randint(80, 200))] for _ in range(25)]
    texts = []
    for o in originals:
        for _ in range(random.choice([1, 1, 2, 6])):
            t = list(o)
            for _ in range(random.randint(0, 6)):
                t[random.randrange(len(t))] = random.choice(words)
            texts.append(" ".join(t))
    hub = originals[0]  # many copies that resemble the original more than each other
    texts += [" ".join(hub)] + [" ".join(w if random.random() > 0.015 else "new" for w in hub) for _ in range(40)]
    sequences = om.shingles(texts)
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if om.aligned(sequences[i], sequences[j]) > 0:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    found = {r.doc_id: r for r in om.near_duplicates(docs_of(spark, list(enumerate(texts)))).collect()}
    assert {i: r.class_id for i, r in found.items()} == {i: root(i) for i in range(len(texts))}
    assert all(r.class_size == sum(root(j) == root(i) for j in range(len(texts))) for i, r in found.items())


def test_template_of_many_unlike_texts(spark):
    """Pairs at 0.8 that meet only in the buckets of a template which all texts share."""
    random.seed(9)

    def words(count):
        return ["".join(random.choice("abcdefghij") for _ in range(7)) for _ in range(count)]

    def buckets(text):
        return set(om.sketch(om.shingles([" ".join(text)])[0]).tolist())

    template = words(144)
    texts = [template + words(60) for _ in range(200)]
    hot = set.union(*map(buckets, texts[:50])) & set.union(*map(buckets, texts[50:]))
    while len(texts) < 220:
        shared = template + words(38)
        pair = [shared + words(22), shared + words(22)]
        both = buckets(pair[0]) & buckets(pair[1])
        if both and both <= hot:
            texts += pair
    texts = [" ".join(t) for t in texts]
    sequences = om.shingles(texts)
    near = {(i, j) for j in range(len(texts)) for i in range(j) if om.aligned(sequences[i], sequences[j]) > 0}
    assert near == {(i, i + 1) for i in range(200, 220, 2)}
    found = {r.doc_id: (r.class_id, r.class_size) for r in om.near_duplicates(docs_of(spark, list(enumerate(texts)))).collect()}
    assert found == {i: (i - i % 2, 2) if i >= 200 else (i, 1) for i in range(220)}


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(7, 7)]
    rows = components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()
    assert {r.node: r.root for r in rows} == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 150)}


def test_components_with_further_edges(spark):
    random.seed(9)
    first = [(random.randrange(300), random.randrange(300)) for _ in range(110)]
    more = [(random.randrange(340), random.randrange(340)) for _ in range(60)] + [(400, 401), (5, 5)]
    table = lambda rows: spark.createDataFrame(rows, "a long, b long")
    found = extended(components(table(first), "a", "b"), table(more), "a", "b").collect()
    whole = components(table(first + more), "a", "b").collect()
    assert len(found) == len(whole) and {(r.node, r.root) for r in found} == {(r.node, r.root) for r in whole}
    assert extended(components(table([]), "a", "b"), table(more[:3]), "a", "b").count() == components(table(more[:3]), "a", "b").count()


def test_odd_rows(spark):
    docs = docs_of(spark, ODD)
    found = om.near_duplicates(docs).collect()
    assert sorted((r.doc_id or 0, r.class_id, r.class_size) for r in found) == [
        (0, 1, 3), (0, 5, 2), (1, 1, 3), (2, 1, 3), (3, 3, 2), (3, 3, 2), (4, 4, 1), (5, 5, 2),
    ]
    kept = om.without_near_duplicates(docs).collect()
    assert sorted((r.doc_id or 0, (r.text or "")[:5]) for r in kept) == [(0, ""), (0, REPEATED[:5]), (3, "x"), (4, "long ")]
    assert om.without_near_duplicates(docs).columns == docs.columns
    assert om.near_duplicates(docs.limit(0)).count() == 0 and om.without_near_duplicates(docs.limit(0)).count() == 0


def test_profiles_bound_what_can_match():
    random.seed(4)
    for limit in (5, 300, 5_000):
        x, y = ([random.randrange(limit) for _ in range(random.randint(1, 2_000))] for _ in range(2))
        x, y = om.mixed(np.array(x, np.uint64)), om.mixed(np.array(y, np.uint64))
        common = len(np.intersect1d(om.labelled(x), om.labelled(y)))
        assert common <= om.most_matches([om.profile(x)], [om.profile(y)])[0] <= max(len(x), len(y)) + 256 * (1 + max(len(x), len(y)) // 255)


def test_words_of_all_scripts():
    def words(text):
        return om.words_of([text])[0].tolist()

    assert words("It’s “fine”—no doubt") == words("it s fine no doubt")
    assert words("Été naïve") == words("été, naïve!") and len(words("été")) == 1
    assert len(words("今日は、天気")) == 5


def test_near_copies_by_words(spark):
    """Copies with one word in sixteen edited are one class with their original; unlike texts stay alone."""
    random.seed(12)
    words = ["".join(random.choice("abcdefgh") for _ in range(5)) for _ in range(3_000)]
    texts, origin = [], []
    for o in range(60):
        text = random.choices(words, k=random.randint(100, 300))
        for copy in range(random.choice([1, 2, 4, 12])):
            edited = [random.choice(words) if copy and random.random() < 1 / 16 else w for w in text]
            texts.append(" ".join(edited))
            origin.append(o)
    found = {r.doc_id: r.class_id for r in om.near_duplicates(docs_of(spark, list(enumerate(texts))), by="words").collect()}
    assert all(origin[i] == origin[c] for i, c in found.items())
    copies = [i for i in found if i and origin[i] == origin[i - 1]]
    assert sum(found[i] == found[origin.index(origin[i])] for i in copies) >= 0.95 * len(copies)
    own = [om.units(om.packed(w), "words") for w in om.words_of(texts)]
    for i, c in found.items():
        assert i == c or any(om.aligned(own[i], own[j]) > 0 for j in found if j != i and found[j] == c)
