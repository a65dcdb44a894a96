import hashlib
import random

import numpy as np
import pandas as pd
import pytest
from odd_rows import docs_of

from cashtide.llm import suffix_dedup as sd


def brute(texts, length):
    seen = {}
    for data in texts:
        for p in range(len(data) - length + 1):
            seen[data[p : p + length]] = seen.get(data[p : p + length], 0) + 1
    out = []
    for data in texts:
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - length + 1):
            if seen[data[p : p + length]] > 1:
                gone[p : p + length] = True
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("size", [1, 2, 9, 60, 900])
@pytest.mark.parametrize("letters", [2, 26])
def test_suffix_array_and_common_prefixes(size, letters):
    random.seed(size)
    x = np.array([random.choice([0, 255, *range(letters)]) for _ in range(size)], np.uint8)
    if size > 600:
        x[300:600] = x[:300]
    data = x.tobytes()
    order = sd.suffix_array(x)
    assert order.tolist() == sorted(range(size), key=lambda i: data[i:])

    def common(a, b):
        return next((k for k in range(40) if max(a, b) + k >= size or data[a + k] != data[b + k]), 40)

    rows = np.unique([0, *(random.randrange(size) for _ in range(size // 50))])
    assert sd.common_prefixes(x, order, rows, 40).tolist() == [0] + [common(a, b) for a, b in zip(order[:-1], order[1:])]


def test_shards_merge_by_binary_search():
    random.seed(2)
    base = bytes(random.choice(b"abcdefgh") for _ in range(3_000))
    contexts = [base[a : a + 736] for a in (0, 100, 1_500)] + [bytes(random.choice(b"xyz") for _ in range(50)) + base[50:600]]
    places = np.arange(4, dtype=np.int64) << 32
    whole = set(sd.repeated_stretches(contexts, places, np.zeros(4, bool)))
    parts = set(sd.repeated_stretches(contexts, places, np.zeros(4, bool), shard_bytes=700))
    assert whole == parts and {i for i, _, _ in whole} == {0, 1, 3}


@pytest.mark.parametrize("hot", [500, 4])
def test_equals_brute_force(spark, hot):
    random.seed(5)
    base = ["".join(random.choice("abcdefgh ") for _ in range(1_500)) for _ in range(6)]
    texts = []
    for i in range(60):
        t = "".join(random.choice("xyzw é") for _ in range(random.randint(0, 300)))
        for _ in range(random.randint(0, 3)):
            a = random.randint(0, 900)
            t += random.choice(base[:3] if i % 3 else base)[a : a + random.randint(350, 900)] + "".join(random.choice("xyz") for _ in range(60))
        texts.append(t)
    passage = base[5][:390]
    texts += ["".join(random.choice("klmno") for _ in range(500)) + passage + "".join(random.choice("klmno") for _ in range(500)) for _ in range(12)]
    texts += ["a" * 1_000, "a" * 399, "a" * 400, None, "", "ab" * 700]
    found = sd.removed(docs_of(spark, list(enumerate(texts))), hot=hot).collect()
    wanted = brute([(t or "").encode() for t in texts], sd.LENGTH)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == dict(enumerate(wanted))
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in found)


def test_one_window_context_of_a_hot_key(spark):
    """One text has nothing but the window on a part's edge; the others of the hot key hold it in wider contexts."""
    random.seed(6)
    edge = -(-(sd.LENGTH - sd.GRAM + 1) // 2) - 1  # the last offset of the first half

    def noise(letters, size):
        return "".join(random.choice(letters) for _ in range(size))

    def window(text, passage):
        """(lo, hi) of the anchor in the passage, if the passage's window chose it."""
        at = text.index(passage) + edge
        return next(((int(lo), int(hi)) for _, p, _, los, his in sd.anchors([text.encode()]) for q, lo, hi in zip(p, los, his) if q == at and lo <= edge <= hi), None)

    last = None  # a letter behind the passage whose gram is the least of the next window
    while last is None:
        passage = noise("abcdefgh", sd.LENGTH)
        if window(passage, passage):
            last = next((c for c in "klmnopqrstuvwxyz" if window(passage + c, passage)[0] == edge), None)
    letters = [c for c in "ABCDEFGHIJKL" if window(passage + c, passage)[0] < edge]
    texts = [noise("klmno", 300) + passage + random.choice(letters) + noise("pqrst", 300) for _ in range(12)]
    lone = noise("klmno", 300) + passage + last + noise("pqrst", 300)
    texts.append(lone)
    found = {r.doc_id: r.n_removed for r in sd.removed(docs_of(spark, list(enumerate(texts))), hot=4).collect()}
    assert found == {i: row[1] for i, row in enumerate(brute([t.encode() for t in texts], sd.LENGTH))}
    assert min(found.values()) >= sd.LENGTH


def contexts_of(key, anchor, texts):
    """Contexts as a bucket holds them: all windows around an anchor at the same place of every text."""
    hi = min(anchor, sd.LENGTH - sd.GRAM)
    rows = [(key, 9, False, b"%d" % i, anchor, 0, hi, t[anchor - hi : anchor + sd.LENGTH]) for i, t in enumerate(texts)]
    return pd.DataFrame(rows, columns=[x.split(" ")[0] for x in sd._OPEN.split(", ")])


def test_contained_contexts_are_settled_with_their_holder():
    random.seed(7)
    passage = bytes(random.choice(b"abcdefgh") for _ in range(900))
    edited = [passage[:at] + b"#%d" % at + passage[at:] for at in (*range(110, 330, 20), *range(520, 800, 20))]
    batch = contexts_of(1, 400, edited[11:] + [t[1 + len(str(at)) :] for at, t in zip(range(110, 330, 20), edited)] + [passage])
    _, left = sd._collapsed(sd._narrowed(batch, sd.LENGTH), sd.LENGTH)
    stretches, rest = sd._uncontained(left, sd.LENGTH)
    assert len(rest) == 1 and len(left) > 20  # the text without edits holds what the others share
    gone = left[~left["d"].isin(rest["d"])]
    assert {(r.d, r.pos - r.hi, r.pos - r.lo + sd.LENGTH) for r in gone.itertuples()} <= set(stretches.itertuples(index=False, name=None))


@pytest.mark.parametrize("letters", [b"ab", b"a\0"])
def test_holders_equal_brute_force(letters):
    random.seed(len(set(letters)) + letters[-1])
    rows = {}
    for _ in range(400):
        hi, lo = random.randint(0, 8), random.randint(0, 3)
        row = (random.choice((-5, 0, 3)), lo, hi, bytes(random.choices(letters, (9, 1), k=hi + 10 - lo)))
        rows[row] = row
    batch = pd.DataFrame([*rows], columns=["key", "lo", "hi", "data"])
    held = sd._holders(batch, 10)

    def holds(b, a):
        return b is not a and b[0] == a[0] and b[2] >= a[2] and b[1] <= a[1] and b[3][b[2] - a[2] :].startswith(a[3])

    listed = [*rows]
    assert [h >= 0 for h in held] == [any(holds(b, a) for b in listed) for a in listed]
    assert all(holds(listed[h], a) for h, a in zip(held, listed) if h >= 0) and 0 < (held >= 0).sum() < len(listed)


@pytest.mark.parametrize("hot", [10_000, 20])
def test_many_edited_copies(spark, monkeypatch, hot):
    """Copies of a passage with an edit or two each: suffix arrays get few of them, texts are moved once, results are exact."""
    random.seed(8)
    passage = "".join(random.choice("abcdefgh ") for _ in range(1_600))
    texts = [passage] * 2 + [passage[random.randint(0, 300) :] for _ in range(10)]
    for i in range(90):
        t = passage
        for at in random.sample(range(1_600), 1 + i % 3):
            t = t[:at] + random.choice("XYZ") + t[at + random.randint(0, 2) :]
        texts.append("".join(random.choice("klmn") for _ in range(i % 7)) + t)
    fetched = []
    with_bytes = sd._with_bytes
    monkeypatch.setattr(sd, "_with_bytes", lambda *x: fetched.append(1) or with_bytes(*x))
    found = sd.removed(docs_of(spark, list(enumerate(texts))), hot=hot).collect()
    wanted = brute([t.encode() for t in texts], sd.LENGTH)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == dict(enumerate(wanted))
    assert len(fetched) == 1


def test_copies_of_one_text_stay_where_they_are(spark, monkeypatch):
    """Rows of a gram or a context that many copies share meet their counts by broadcast, not in one task."""
    random.seed(9)
    text = "".join(random.choice("abcdefgh ") for _ in range(900))
    texts = [text] * 300 + [text[i:] + "x" * i for i in range(1, 30)]
    rows, looked_up = {}, sd.looked_up

    def noted(left, table, keys, copies, total):
        out = looked_up(left, table, keys, copies, total)
        key = ",".join(keys)
        rows[key] = max(rows.get(key, 0), table.where(f"{copies} > {max(1, total // 1_000)}").agg({copies: "max"}).first()[0] or 0)
        return out

    monkeypatch.setattr(sd, "looked_up", noted)
    found = sd.removed(docs_of(spark, list(enumerate(texts)))).collect()
    wanted = brute([t.encode() for t in texts], sd.LENGTH)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == dict(enumerate(wanted))
    assert rows["key"] >= 300 and rows["key,c"] >= 300


def test_repeated_rows_and_ids(spark):
    text, other = "z" + "abc" * 200, "".join(chr(97 + i * i % 23) for i in range(700))
    rows = sd.removed(docs_of(spark, [(1, text), (1, text), (None, other), (None, other), (2, "q" * 100)])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in rows) == [(0, 700), (0, 700), (1, 601), (1, 601), (2, 0)]
    assert sd.removed(docs_of(spark, [])).count() == 0
