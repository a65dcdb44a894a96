"""Removal of repeated byte strings, by suffix arrays over the places where text can repeat.

Every byte that is covered by a ``length``-byte string which also starts anywhere else is removed.

1. Anchors.  Each window of ``length`` bytes chooses the 64-byte grams in it with the least hash
   (winnowing).  Equal windows choose equal grams, so a window whose grams occur once in the corpus is
   unique, and only the surroundings of shared grams go on: a lossless cut from all positions to
   about one in 169.
2. Contexts.  An anchor's context is the text that the windows which chose it cover.  Equal contexts
   are counted by digest; what occurs twice is repeated as a whole, and one representative stays.
   Copies of any number, and the inside of a shared passage, thus become one row.
3. Buckets.  Contexts of one gram share a bucket of bounded size.  Sorting them by the text after and
   before the anchor bounds how far each agrees with any other; windows beyond are unique and go,
   and contexts that are now equal are one row again.  A context whose whole text another one of its
   key holds is repeated, and so is that part of its holder, which stays for both; the agreement of
   those that stay is bounded again.
   The rest is cut in shards.  Each shard gets a suffix array by Larsson-Sadakane refinement (ranks
   double in depth, only unsettled groups are sorted again) and Kasai common prefixes; strings that
   share ``length`` bytes are neighbours.  Shards of a bucket are merged by binary search of one's
   strings in the other's suffix array.
4. Hot grams.  If a gram has too many different contexts for a bucket, its windows are dealt to two
   halves by their offset from the anchor; the windows of a half share more bytes, and these become
   the new key.  After at most nine halvings a key is a whole window.  So no bucket grows with the
   frequency of a passage and no pairs of shards or documents are listed.
5. The covered stretches of each document are joined with its text.

All steps are exact; hashes only decide what is compared (digests of equal contexts have 128 bits).

Defined cases: a null text is an empty one; texts under ``length`` bytes keep everything; repeated
rows, also with equal ids, count as other places of each other; null ids are kept; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashtide.llm.lookups import looked_up
from cashtide.sources.workspace import materialize

LENGTH = 400
GRAM = 64
PORTION_BYTES = 120_000  # of text at a time, so that its arrays stay in the processor's cache
PORTION_ROWS = 10_000
BATCH_BYTES = 1_000_000
BUCKET_BYTES = 2_000_000
SHARD_BYTES = 1_500_000
PAIRS = 1_000_000
HOT = 10_000  # different contexts of one key that still go to one bucket: 6 MB
_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)


# ---- anchors ---------------------------------------------------------------------------------------


def _powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _sliding(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Least (or greatest) of each ``width`` neighbours, by running extremes within blocks."""
    op, fill = (np.minimum, _MOST) if least else (np.maximum, np.uint64(0))
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, fill, np.uint64)
    padded[: len(values)] = values
    table = padded.reshape(blocks, width)
    ahead = op.accumulate(table, axis=1).ravel()
    behind = op.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(values) - width + 1
    return op(behind[:count], ahead[width - 1 : width - 1 + count])


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text number, positions, gram hashes, lo, hi) of the texts that have windows.

    The windows that chose an anchor start lo to hi bytes before it.
    """
    usable = [i for i, t in enumerate(texts) if len(t) >= length]
    if not usable:
        return
    data = np.frombuffer(b"".join(texts[i] for i in usable), np.uint8)
    n = len(data)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), dtype=np.uint64)))
    x = (sums[gram:] - sums[:-gram]) * _powers(_INVERSE, n - gram + 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    ends = np.cumsum([len(texts[i]) for i in usable])
    for end in ends[:-1]:  # grams across texts are never the least of a window that counts
        x[end - gram + 1 : end] = _MOST
    width = length - gram + 1
    least = _sliding(x, width, True)
    for end in ends[:-1]:
        least[end - length + 1 : end] = 0  # windows across texts
    # A gram is chosen if it is the least of some window over it: the greatest of those minima.
    around = np.concatenate((np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)))
    chosen = np.flatnonzero(_sliding(around, width, False) == x)
    # Windows with one least value form runs; an anchor is chosen by the part of its run that holds it.
    runs = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    stops = np.append(runs[1:], len(least)) - 1
    run = np.searchsorted(runs, chosen, side="right") - 1
    while len(wrong := np.flatnonzero(least[runs[run]] != x[chosen])):
        run[wrong] -= 1
    lo, hi = chosen - np.minimum(stops[run], chosen), chosen - np.maximum(runs[run], chosen - width + 1)
    owner = np.searchsorted(ends, chosen, side="right")
    cuts = np.searchsorted(owner, np.arange(len(usable) + 1))
    for k, i in enumerate(usable):
        at = chosen[cuts[k] : cuts[k + 1]]
        yield i, at - (ends[k] - len(texts[i])), x[at], lo[cuts[k] : cuts[k + 1]], hi[cuts[k] : cuts[k + 1]]


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


# ---- suffix arrays ---------------------------------------------------------------------------------


def words_of(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as a number; zeros behind the end."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    out = np.zeros(len(data), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k : k + len(data)]
    return out


def _order(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Order by two numbers below 2^21 each, by sorting packed 64-bit keys; larger ones by lexsort."""
    n = len(first)
    if max(first.max(initial=0), second.max(initial=0), n) < 1 << 21:
        packed = first.astype(np.uint64) << np.uint64(42) | second.astype(np.uint64) << np.uint64(21) | np.arange(n, dtype=np.uint64)
        packed.sort()
        return (packed & np.uint64((1 << 21) - 1)).astype(np.int64)
    return np.lexsort((second, first))


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Larsson-Sadakane: ranks of growing depth; groups that are settled are left alone."""
    n = len(data)
    order = np.argsort(words_of(data), kind="stable")
    key = words_of(data)[order]
    # Zeros behind the end and zero bytes look alike at first: the shorter suffix comes first.
    tail = np.flatnonzero(order > n - 8)
    new = np.concatenate(([True], key[1:] != key[:-1]))
    if len(tail):
        size = np.minimum(n - order, 8)
        group = np.cumsum(new)
        order = order[np.lexsort((size, group))]
        size = np.minimum(n - order, 8)
        new[1:] |= size[1:] != size[:-1]
    rank = np.empty(n, np.int64)
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[order] = start
    open_ = np.flatnonzero(~(new & np.append(new[1:], True)))  # places in groups of two or more
    depth = 8
    while len(open_):
        members = order[open_]
        behind = members + depth
        second = np.where(behind < n, rank[np.minimum(behind, n - 1)] + 1, 0)
        inside = _order(rank[members], second)
        members, second = members[inside], second[inside]
        first = rank[members]
        order[open_] = members
        fresh = np.concatenate(([True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])))
        heads = np.flatnonzero(fresh)
        rank[members] = np.repeat(open_[heads], np.diff(np.append(heads, len(open_))))
        open_ = open_[~(fresh & np.append(fresh[1:], True))]
        depth *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, rows: np.ndarray, most: int) -> np.ndarray:
    """Kasai: the common prefix of each suffix with the one before it in order, up to ``most``.

    From one position to the next it shrinks by one at most.  All rows (their starts are given) are
    walked at the same time.
    """
    n = len(data)
    words = np.concatenate((words_of(data), np.zeros(most + 8, np.uint64)))
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, np.int64)
    sizes = np.diff(np.append(rows, n))
    held = np.zeros(len(rows), np.int64)
    by_size = np.argsort(-sizes, kind="stable")
    rows, sizes = rows[by_size], sizes[by_size]
    for t in range(int(sizes[0]) if len(sizes) else 0):
        live = int(np.searchsorted(-sizes, -t, side="left"))
        i = rows[:live] + t
        j = before[i]
        h = np.maximum(held[:live] - 1, 0)
        going = np.flatnonzero((j >= 0) & (h < most))
        while len(going):
            a, b = words[i[going] + h[going]], words[j[going] + h[going]]
            same = a == b
            differ = going[~same]
            if len(differ):
                x = (a ^ b)[~same]
                equal = np.zeros(len(x), np.int64)
                for k in range(7, 0, -1):
                    equal += x < np.uint64(1) << np.uint64(8 * k)
                h[differ] += equal
            going = going[same]
            h[going] += 8
            going = going[h[going] < most]
        h = np.where(j >= 0, np.minimum(np.minimum(h, most), n - np.maximum(i, j)), 0)
        held[:live] = h
        out[i] = h
    return out[order]


class Shard:
    """The windows of some contexts in suffix order, grouped by equal content."""

    def __init__(self, contexts: list[bytes], places: np.ndarray, multiple: np.ndarray, length: int):
        """``places`` numbers the place of each context's first byte; ``multiple``: it occurs twice."""
        self.length = length
        sizes = np.array([len(c) for c in contexts])
        rows = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        data = np.frombuffer(b"".join(contexts), np.uint8)
        order = suffix_array(data)
        shared = common_prefixes(data, order, rows, length)
        row = np.repeat(np.arange(len(sizes)), sizes)
        offset = np.arange(len(data)) - rows[row]
        starts = offset + length <= sizes[row]  # a whole window of its context starts here
        run = np.cumsum(shared < length)[starts[order]]
        self.windows = order[starts[order]]
        self.group = np.cumsum(np.concatenate(([0], run[1:] != run[:-1])))
        self.first = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))
        place = places[row[self.windows]] + offset[self.windows]
        self.least, self.most = np.minimum.reduceat(place, self.first), np.maximum.reduceat(place, self.first)
        self.multiple = np.maximum.reduceat(multiple[row[self.windows]], self.first)
        self.row, self.offset = row[self.windows], offset[self.windows]
        self.words = np.concatenate((words_of(data), np.zeros(length, np.uint64)))

    def search(self, other: Shard) -> tuple[np.ndarray, np.ndarray]:
        """(own groups, the other's groups) of equal windows, by binary search in suffix order."""
        own, targets = self.windows[self.first], other.windows[other.first]
        low, high = np.zeros(len(own), np.int64), np.full(len(own), len(targets))
        found = np.full(len(own), -1)
        live = np.arange(len(own))
        while len(live):
            middle = (low[live] + high[live]) // 2
            sign = self._compare(own[live], other, targets[middle])
            found[live[sign == 0]] = middle[sign == 0]
            high[live[sign < 0]] = middle[sign < 0]
            low[live[sign > 0]] = middle[sign > 0] + 1
            live = live[(sign != 0) & (low[live] < high[live])]
        hit = np.flatnonzero(found >= 0)
        return hit, found[hit]

    def _compare(self, own: np.ndarray, other: Shard, theirs: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 for each pair of windows."""
        sign = np.zeros(len(own), np.int8)
        live = np.arange(len(own))
        for at in [*range(0, self.length - 7, 8), *([self.length - 8] if self.length % 8 else [])]:
            a, b = self.words[own[live] + at], other.words[theirs[live] + at]
            sign[live] = (a > b).astype(np.int8) - (a < b)
            live = live[a == b]
            if not len(live):
                break
        return sign

    def merge(self, other: Shard) -> None:
        """Equal windows of two shards share their places."""
        a, b = self.search(other)
        self.least[a] = other.least[b] = np.minimum(self.least[a], other.least[b])
        self.most[a] = other.most[b] = np.maximum(self.most[a], other.most[b])
        self.multiple[a] = other.multiple[b] = np.maximum(self.multiple[a], other.multiple[b])

    def repeated(self) -> tuple[np.ndarray, np.ndarray]:
        """(context, offset) of the windows that also start elsewhere, in that order."""
        hit = ((self.least != self.most) | self.multiple)[self.group]
        row, offset = self.row[hit], self.offset[hit]
        order = np.lexsort((offset, row))
        return row[order], offset[order]


def repeated_stretches(contexts: list[bytes], places: np.ndarray, multiple: np.ndarray, length: int = LENGTH, shard_bytes: int = SHARD_BYTES):
    """(context, start, stop) of the bytes of each context that repeated windows cover."""
    cuts, size = [0], 0
    for i, c in enumerate(contexts):
        if size and size + len(c) > shard_bytes:
            cuts.append(i)
            size = 0
        size += len(c)
    cuts.append(len(contexts))
    shards = [Shard(contexts[a:b], places[a:b], multiple[a:b], length) for a, b in zip(cuts, cuts[1:])]
    for i, shard in enumerate(shards):
        for other in shards[i + 1 :]:
            shard.merge(other)
    for first, shard in zip(cuts, shards):
        row, offset = shard.repeated()
        if len(row):
            new = np.concatenate(([True], (row[1:] != row[:-1]) | (offset[1:] > offset[:-1] + length)))
            begin = np.flatnonzero(new)
            end = np.append(begin[1:], len(row)) - 1
            for b, e in zip(begin, end):
                yield first + int(row[b]), int(offset[b]), int(offset[e]) + length


# ---- the corpus ------------------------------------------------------------------------------------

_PLACES = "key long, c binary, d binary, pos int, lo int, hi int"


def doc_key(doc_id: Column, text: Column) -> Column:
    name = F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"), text)
    return F.unhex(F.md5(name.cast("binary")))


def anchored(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(key, c, d, pos, lo, hi): every anchor of every document with the digest of its context."""
    names = [x.split(" ")[0] for x in _PLACES.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, rows = batch["d"].tolist(), []
            for first, texts in _portions(batch["text"].tolist()):
                if len(rows) > PORTION_ROWS:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
                for i, *columns in anchors(texts, length):
                    text, d = texts[i], keys[first + i]
                    columns[1] = columns[1].view(np.int64)
                    for p, g, lo, hi in zip(*(c.tolist() for c in columns)):
                        rows.append((g, _digest(b"%d,%d:" % (lo, hi) + text[p - hi : p - lo + length]), d, p, lo, hi))
            yield pd.DataFrame(rows, columns=names)

    return docs.select("d", "text").mapInPandas(run, _PLACES)


def _portions(texts: list[str]) -> Iterator[tuple[int, list[bytes]]]:
    held, size, first = [], 0, 0
    for text in texts:
        held.append(text.encode("utf-8", "surrogatepass"))
        size += len(held[-1])
        if size >= PORTION_BYTES:
            yield first, held
            first += len(held)
            held, size = [], 0
    if held:
        yield first, held


def _equal_contexts(rows: DataFrame, length: int, *data: str) -> tuple[DataFrame, DataFrame]:
    """Stretches of contexts that occur twice, and one row per different context where it may match.

    The second frame has the contexts of keys with two or more, of which at least one is single.
    """
    place = F.struct("d", "pos", "lo", "hi", *data)
    contexts = rows.groupBy("key", "c").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    contexts = materialize(contexts, "contexts")
    twice = contexts.where("n > 1").select("key", "c", "n")
    both = looked_up(rows.drop(*data), twice, ["key", "c"], "n", rows.count()).where("n is not null")
    stretches = both.select("d", (F.col("pos") - F.col("hi")).alias("start"), (F.col("pos") - F.col("lo") + length).alias("stop"))
    kinds = contexts.groupBy("key").agg(F.count(F.lit(1)).alias("contexts"), F.min("n").alias("fewest"))
    kinds = materialize(kinds.where("contexts > 1 and fewest = 1").drop("fewest"), "open-keys")
    open_ = looked_up(contexts, kinds, ["key"], "contexts", contexts.count()).where("contexts is not null")
    return stretches, open_.select("key", "contexts", (F.col("n") > 1).alias("multiple"), "first.*")


_OPEN = "key long, contexts long, multiple boolean, d binary, pos int, lo int, hi int, data binary"


def _with_bytes(open_: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """Adds the bytes of each context from the documents."""
    wanted = open_.groupBy("d").agg(F.collect_list(F.struct("key", "contexts", "multiple", "pos", "lo", "hi")).alias("at"))
    names = [x.split(" ")[0] for x in _OPEN.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, held = [], 0
            for d, text, at in zip(batch["d"], batch["text"], batch["at"]):
                data = text.encode("utf-8", "surrogatepass")
                for w in at:
                    piece = data[w["pos"] - w["hi"] : w["pos"] - w["lo"] + length]
                    rows.append((w["key"], w["contexts"], w["multiple"], d, w["pos"], w["lo"], w["hi"], piece))
                    held += len(piece)
                if held > BATCH_BYTES:
                    yield pd.DataFrame(rows, columns=names)
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=names)

    joined = docs.select("d", "text").join(wanted, "d").dropDuplicates(["d"])
    return joined.mapInPandas(run, _OPEN)


def _width(level: int, length: int) -> int:
    """How many offsets a part has after so many halvings."""
    return -(-(length - GRAM + 1) // 2**level)


def _halved(hot: DataFrame, level: int, length: int) -> DataFrame:
    """The windows of each context by parts of the offsets, keyed by the bytes that a part shares."""
    width = _width(level, length)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                for part in range(r.lo // width, r.hi // width + 1):
                    lo, hi = max(r.lo, part * width), min(r.hi, part * width + width - 1)
                    common = r.data[r.hi - part * width :][: length - width + 1]
                    key = int.from_bytes(_digest(b"%d,%d:" % (level, part) + common)[:8], "little", signed=True)
                    own = r.data[r.hi - hi : r.hi - lo + length]
                    rows.append((key, _digest(b"%d,%d:" % (lo, hi) + own), r.d, r.pos, lo, hi, r.multiple, own))
            yield pd.DataFrame(rows, columns=["key", "c", "d", "pos", "lo", "hi", "multiple", "data"])

    return hot.mapInPandas(run, _PLACES + ", multiple boolean, data binary")


def _neighbours(group: np.ndarray, texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the texts within their groups, and the bytes that each shares with the next one (-1 across groups)."""
    keyed = np.array([int(g).to_bytes(8, "big") + t for g, t in zip(group, texts)], f"S{8 + length}")
    order = np.argsort(keyed, kind="stable")
    table = keyed[order].view(np.uint8).reshape(len(texts), 8 + length)
    differ = table[1:] != table[:-1]
    shared = np.where(differ.any(1), differ.argmax(1), 8 + length)
    return order, np.maximum(shared - 8, np.where(shared < 8, -1, 0))


def _agreement(group: np.ndarray, texts: list[bytes], length: int) -> np.ndarray:
    """How many bytes each text shares at most with another one of its group, from its start on."""
    order, shared = _neighbours(group, texts, length)
    out = np.full(len(texts), -1)
    out[order[1:]] = shared
    out[order[:-1]] = np.maximum(out[order[:-1]], shared)
    return out


def _extensions(group: np.ndarray, texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, first, last): each text's place in order, and the places of the texts of its group that begin with it.

    Zeros behind the end of a text count as part of it: callers compare lengths, too.
    """
    order, shared = _neighbours(group, texts, length)
    need = np.array([len(texts[i]) for i in order])
    least = [shared]  # of 1, 2, 4, ... neighbours
    while len(least[-1]) > 1 << len(least) - 1:
        half = 1 << len(least) - 1
        least.append(np.minimum(least[-1][:-half], least[-1][half:]))
    low, high = np.arange(len(texts)), np.arange(len(texts))
    for k in range(len(least) - 1, -1, -1):
        if len(least[k]):
            behind = high < len(least[k])
            high += (behind & (least[k][np.where(behind, high, 0)] >= need)).astype(np.int64) << k
            ahead = low >= 1 << k
            low -= (ahead & (least[k][np.where(ahead, low - (1 << k), 0)] >= need)).astype(np.int64) << k
    place, first, last = (np.empty(len(texts), np.int64) for _ in range(3))
    place[order], first[order], last[order] = np.arange(len(texts)), low, high
    return place, first, last


def _narrowed(batch: pd.DataFrame, length: int) -> pd.DataFrame:
    """The contexts with only those offsets at which a window can agree with another context.

    With at most R bytes in common after the anchor and L before it, offsets are length - R to L.
    """
    group = pd.factorize(batch["key"])[0]
    after = [d[hi:] for d, hi in zip(batch["data"], batch["hi"])]
    before = [d[:hi][::-1] for d, hi in zip(batch["data"], batch["hi"])]
    right, left = _agreement(group, after, length), _agreement(group, before, length)
    lo, hi = np.maximum(batch["lo"], length - right), np.minimum(batch["hi"], left)
    cut = [d[h - b : h - a + length] for d, h, a, b in zip(batch["data"], batch["hi"], lo, hi)]
    return batch.assign(data=cut, lo=lo, hi=hi)[lo <= hi]


def _collapsed(batch: pd.DataFrame, length: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Narrowed contexts that occur twice, as stretches, and one row per different context.

    Keys without a single context, or with one context only, need no more comparing.
    """
    same = ["key", "lo", "hi", "data"]
    twice = batch.duplicated(same, keep=False)
    stretches = batch[twice].assign(start=batch["pos"] - batch["hi"], stop=batch["pos"] - batch["lo"] + length)
    firsts = batch.assign(multiple=batch["multiple"] | twice).drop_duplicates(same)
    by_key = firsts.groupby("key")["multiple"]
    left = firsts[~by_key.transform("all") & (by_key.transform("size") > 1)]
    return stretches[["d", "start", "stop"]], left.reset_index(drop=True)


def _holders(batch: pd.DataFrame, length: int) -> np.ndarray:
    """For each context another one of its key that holds all its text, around the same anchor; -1 where none does.

    No two contexts may be equal.  Pairs of one key are compared by their places in two orders, not by text.
    """
    group = pd.factorize(batch["key"])[0]
    lo, hi = batch["lo"].to_numpy(np.int64), batch["hi"].to_numpy(np.int64)
    sides = [
        _extensions(group, [d[h:] for d, h in zip(batch["data"], hi)], length),
        _extensions(group, [d[:h][::-1] for d, h in zip(batch["data"], hi)], length),
    ]
    out = np.full(len(batch), -1)
    members = np.argsort(group, kind="stable")
    for b in np.split(members, np.flatnonzero(np.diff(group[members])) + 1):
        step = max(1, PAIRS // len(b))
        for at in range(0, len(b), step):
            a = b[at : at + step, None]
            fits = (lo[b] <= lo[a]) & (hi[b] >= hi[a]) & (a != b)
            for place, first, last in sides:
                fits &= (place[b] >= first[a]) & (place[b] <= last[a])
            out[a[:, 0]] = np.where(fits.any(1), b[fits.argmax(1)], -1)
    return out


def _uncontained(batch: pd.DataFrame, length: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Stretches of contexts that another one of their key holds, in both places, and the other contexts.

    What agrees with a part of a contained context agrees with its holder, so nothing is lost with it.
    """
    holder = _holders(batch, length)
    inner = batch[holder >= 0]
    outer = batch.iloc[holder[holder >= 0]][["d", "pos"]].assign(lo=inner["lo"].to_numpy(), hi=inner["hi"].to_numpy())
    both = pd.concat([inner[["d", "pos", "lo", "hi"]], outer.drop_duplicates()], ignore_index=True)
    stretches = both.assign(start=both["pos"] - both["hi"], stop=both["pos"] - both["lo"] + length)
    return stretches[["d", "start", "stop"]], batch[holder < 0].reset_index(drop=True)


def _in_buckets(rows: DataFrame, buckets: int, length: int) -> DataFrame:
    """(d, start, stop) of the repeated stretches of contexts, bucket by bucket."""

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        done = []
        for step in (_collapsed, _uncontained, _collapsed):
            more, batch = step(_narrowed(batch, length) if step is _collapsed else batch, length)
            done.append(more)
            if batch.empty:
                return pd.concat(done, ignore_index=True)
        starts = (batch["pos"] - batch["hi"]).to_numpy(np.int64)
        document, names = pd.factorize(batch["d"])
        places = document.astype(np.int64) << 32 | starts
        found = [
            (names[document[i]], starts[i] + a, starts[i] + b)
            for i, a, b in repeated_stretches(batch["data"].tolist(), places, batch["multiple"].to_numpy(bool), length)
        ]
        return pd.concat([*done, pd.DataFrame(found, columns=["d", "start", "stop"])], ignore_index=True)

    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInPandas(run, "d binary, start int, stop int")


def _bucket_count(open_: DataFrame, length: int) -> int:
    total = open_.agg(F.sum(F.col("hi") - F.col("lo") + length)).first()[0] or 0
    return max(1, -(-total // BUCKET_BYTES))


def repeated(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(d, start, stop): stretches, possibly overlapping, of the documents (d, text) to remove."""
    places = materialize(anchored(docs, length), "anchors")
    shared = materialize(places.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared-keys")
    rows = looked_up(places, shared, ["key"], "n", places.count()).where("n is not null").drop("n")
    rows = materialize(rows, "shared-anchors")
    found, open_ = _equal_contexts(rows, length)
    found, level = [found], 0
    open_ = materialize(open_, "open-contexts")
    any_hot = not open_.where(f"contexts > {hot}").isEmpty()
    buckets = _bucket_count(open_.where(f"contexts <= {hot}"), length)
    open_ = _with_bytes(open_, docs, length)
    if any_hot:
        open_ = materialize(open_, "open-bytes")  # both halves read it: the texts are moved once
    small, large = open_.where(f"contexts <= {hot}"), open_.where(f"contexts > {hot}")
    found.append(_in_buckets(small, buckets, length))
    if any_hot:
        while True:
            level += 1
            halves = materialize(_halved(large, level, length), "halves")
            if halves.isEmpty():
                break
            # What a representative stands for counts as a second occurrence of its contexts.
            again = halves.where("multiple").withColumn("d", F.lit(b""))
            same, open_ = _equal_contexts(halves.unionByName(again), length, "data")
            found.append(same)
            open_ = materialize(open_, "open-contexts")
            # Contexts of one window go on too: wider ones of the key may hold that window.
            small, large = open_.where(f"contexts <= {hot}"), open_.where(f"contexts > {hot}")
            found.append(_in_buckets(small, _bucket_count(small, length), length))
            if _width(level, length) == 1:
                break  # a key is a whole window and has one context
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.where(F.length("d") > 0)


def removed(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the text that is left) of every row.

    ``kept`` is binary, since a cut may fall inside a character.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("d", doc_key(F.col("doc_id"), F.col("text")))
    spans = repeated(rows, length, hot).groupBy("d").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, spans in zip(batch["text"], batch["spans"]):
                data, kept, at, cut, runs = text.encode("utf-8", "surrogatepass"), [], 0, 0, 0
                last = -1
                for start, stop in sorted((s["start"], s["stop"]) for s in (spans if spans is not None else ())):
                    if start > last:
                        runs += 1
                        kept.append(data[at:start])
                    if stop > at:
                        cut += stop - max(start, at)
                        at = stop
                    last = max(last, stop)
                whole = b"".join([*kept, data[at:]])
                out.append((len(data), cut, runs, hashlib.sha256(whole).hexdigest(), whole))
            ids = batch[["doc_id"]].reset_index(drop=True)
            yield pd.concat([ids, pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])], axis=1)

    joined = rows.join(spans, "d", "left").select("doc_id", "text", "spans")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInPandas(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
