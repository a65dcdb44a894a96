"""Near-duplicates by Order MinHash, verified by banded alignment.

A text is the sequence of its five-word shingles, each labelled with its occurrence number.  A sketch
takes the two labelled shingles with the least hashes and keeps them in text order, so it is equal for
texts that share shingles in the same order.  Two texts are linked if an alignment of their sequences
matches M units with M / (|A| + |B| - M) >= 0.8.  The units are shingles or, with ``by="words"``, words.
An edited word costs one word, but five shingles: texts in which one word in twenty differs are at 0.9 by
words and at 0.6 by shingles.  Every link by shingles is one by words too.

Texts at 0.8 by shingles share a sketch with a chance of about 0.64, so all twelve miss with 5e-6.  With
one word in n edited, texts share (1 - 1/n)^5 of their shingles: 5 % edits miss all sketches with 0.003,
8 % with 0.04.  The links by words are those that sketches find and those that step 3 finds.

1. Equal texts are one class from the start; everything below is about different texts.
2. Sketches are bucket keys, alone and together with the next sketch.  No pairs of a bucket are
   listed: each member is compared with the hub of its bucket, the member whose sketches are shared
   most.  Copies of one original resemble it more than each other, and it shares most sketches.
   Members that do not match it are compared with their neighbours in a random order of the bucket,
   another one in each of its 24 buckets and in each of the ``rounds``.
3. What is left is searched exactly: members of buckets that still hold several classes.  Texts that
   similar share one of the rarest fifth of their labelled shingles, so these are keys, and texts of
   different classes that meet at a key are candidates if the shingles behind it can suffice.  A
   template of many texts is not among their rarest shingles.  Shingles are counted in all these texts;
   any order gives the same links.  This search is complete for the similarity by shingles.
4. Candidates meet by their profiles first, units counted in 256 slots, which bound what can match.
   Only the sequences of pairs that can be similar enough are brought together, and aligned in a band as
   wide as the similarity allows.
5. Links are closed to classes by connected components.

Sizes of buckets and least members are combined in the tasks before shuffles; joins carry no hints, so
hot buckets are split by the planner.  The text is read once for sketches and once a round for the
sequences of new candidates; only candidates' texts are shuffled.

Defined cases: null texts are empty; texts without words are only copies of equal texts; texts of one
to four words have one shingle, all their words; a class whose documents have no ids has a null id;
repeated rows count as documents of the class, and the filter keeps one of them; an empty table gives
an empty result; other columns are ignored or, in the filter, kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cashtide.llm.components import components, extended
from cashtide.sources.workspace import materialize

WORDS = 5
SKETCHES = 12
SIMILARITY = 0.8
ROUNDS = 3
PART_ROWS = 1_000
FREQUENT = 200_000  # shingles whose counts are known to the tasks
SLOTS = 256
PORTION_BYTES = 1_000_000
BATCH_BYTES = 4_000_000  # of rows that a task hands to Python at once; a longer row goes alone
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_SEEDS = np.random.default_rng(20240101).integers(1, 2**63, 2 * SKETCHES, dtype=np.uint64) | np.uint64(1)

_WORD_BYTES = np.zeros(256, bool)
_WORD_BYTES[[*range(48, 58), *range(97, 123), 95, *range(128, 256)]] = True
_SIGNS = re.compile(r"[\x80-\xbf\xd7\xf7]|[^\x00-\u024f]")  # texts of Latin letters only hold none of these
_NO_WORD = regex.compile(r"[^\w\x00-\x7f]+")
_ALONE = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]")


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    if count:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _spaced(text: str) -> str:
    """Lower case, blanks for signs beyond ASCII, and blanks around letters of scripts without blanks."""
    text = text.lower()
    return text if text.isascii() or not _SIGNS.search(text) else _ALONE.sub(r" \g<0> ", _NO_WORD.sub(" ", text))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and the number of words of each text.

    Words are runs of letters, marks, digits and underscores of any script, in lower case; in scripts
    without blanks each letter is a word.
    """
    coded = [_spaced(t).encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(coded) + b" ", np.uint8)
    inside = _WORD_BYTES[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside)).astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), dtype=np.uint64)))
    hashes = mixed((sums[end] - sums[begin]) * _powers(_INVERSE, len(data))[begin])
    limits = np.cumsum([len(c) + 1 for c in coded])
    return hashes, np.diff(np.concatenate(([0], np.searchsorted(begin, limits))))


def words_of(texts: list[str]) -> list[np.ndarray]:
    """The sequence of word hashes of each text."""
    hashes, counts = word_hashes(texts)
    return np.split(hashes, np.cumsum(counts)[:-1]) if texts else []


def shingled(words: np.ndarray) -> np.ndarray:
    """The sequence of shingle hashes of a sequence of word hashes."""
    count = len(words)
    size = min(WORDS, count)
    total = np.zeros(max(count - size + 1, 0) if count else 0, np.uint64)
    for k in range(size):
        total = (total ^ words[k : k + len(total)]) * np.uint64(0x100000001B3) + np.uint64(k)
        total = total ^ (total >> np.uint64(29))
    return mixed(total)


def shingles(texts: list[str]) -> list[np.ndarray]:
    """The sequence of shingle hashes of each text."""
    return [shingled(words) for words in words_of(texts)]


def packed(words: np.ndarray) -> np.ndarray:
    """Word hashes as they are stored: their upper halves."""
    return (words >> np.uint64(32)).astype(np.uint32).view(np.int32)


def units(stored, by: str) -> np.ndarray:
    """The words or shingles of a stored sequence."""
    words = mixed(np.asarray(stored, np.int32).view(np.uint32).astype(np.uint64))
    return words if by == "words" else shingled(words)


def profile(sequence: np.ndarray) -> bytes:
    """Units of the sequence counted in slots: a step, then every count in steps, rounded up."""
    counts = np.bincount((sequence & np.uint64(SLOTS - 1)).astype(np.int64), minlength=SLOTS)
    step = max(1, -(-int(counts.max()) // 255))
    return np.uint32(step).tobytes() + (-(-counts // step)).astype(np.uint8).tobytes()


def most_matches(x: list[bytes], y: list[bytes]) -> np.ndarray:
    """What no alignment of sequences with these profiles can exceed."""

    def counts(profiles: list[bytes]) -> np.ndarray:
        rows = np.frombuffer(b"".join(profiles), np.uint8).reshape(-1, SLOTS + 4)
        return rows[:, 4:].astype(np.int64) * np.ascontiguousarray(rows[:, :4]).view(np.uint32)

    return np.minimum(counts(x), counts(y)).sum(axis=1)


def _portions(texts: list[str]) -> Iterator[list[str]]:
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= PORTION_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def labelled(sequence: np.ndarray) -> np.ndarray:
    """Each shingle together with its occurrence number."""
    order = np.argsort(sequence, kind="stable")
    same = np.concatenate(([False], sequence[order][1:] == sequence[order][:-1]))
    if not same.any():
        return sequence
    rank = np.arange(len(sequence))
    occurrence = np.empty(len(sequence), np.uint64)
    occurrence[order] = rank - np.maximum.accumulate(np.where(same, 0, rank))
    return np.where(occurrence > 0, mixed(sequence + occurrence * _BASE), sequence)


def sketch(sequence: np.ndarray) -> np.ndarray:
    """One number per sketch: the two least labelled shingles, in text order."""
    labels = labelled(sequence)
    ranks = (labels[None, :] ^ _SEEDS[:SKETCHES, None]) * _SEEDS[SKETCHES:, None]
    ranks ^= ranks >> np.uint64(32)
    ranks *= _BASE
    if len(labels) == 1:
        pairs = np.zeros((SKETCHES, 2), np.int64)
    else:
        pairs = np.sort(np.argpartition(ranks, 1, axis=1)[:, :2], axis=1)
    first, second = labels[pairs[:, 0]], labels[pairs[:, 1]]
    return mixed(mixed(first + np.arange(SKETCHES, dtype=np.uint64)) * np.uint64(3) + second)


def aligned(x: np.ndarray, y: np.ndarray, least: float = SIMILARITY) -> float:
    """Similarity of two sequences by banded alignment; 0.0 if it is under ``least``."""
    n, m = len(x), len(y)
    need = int(np.ceil(least * (n + m) / (1 + least) - 1e-9))
    if not n or not m or min(n, m) < need:
        return 0.0
    most = min(n, m)
    different = np.flatnonzero(x[:most] != y[:most])
    head = int(different[0]) if len(different) else most
    different = np.flatnonzero(x[::-1][: most - head] != y[::-1][: most - head])
    tail = int(different[0]) if len(different) else most - head
    matched = head + tail
    x, y = x[head : n - tail], y[head : m - tail]
    want = max(need - matched, 0)
    if len(x) and len(y):
        if len(np.intersect1d(labelled(x), labelled(y), assume_unique=True)) < want:
            return 0.0
        matched += _band(x, y, want)
    return matched / (n + m - matched) if matched >= need else 0.0


def _band(x: np.ndarray, y: np.ndarray, want: int) -> int:
    """Matches of the best alignment that skips at most len - want shingles of either sequence.

    A row of the alignment is one number, whose cleared bits are the columns where the matches grow by one.
    Rows are taken in stretches as long as the band is wide; a stretch sees the columns of its band only.
    """
    below, above = len(x) - want, len(y) - want
    rows = max(64, below + above + 1)
    span = rows + below + above
    full, head = (1 << span) - 1, (1 << rows) - 1
    columns, matched, row = y.tolist(), 0, full
    for start in range(0, len(x), rows):
        if start:
            matched += rows - (row & head).bit_count()
            row = (row >> rows) | (head << (span - rows))
        places: dict[int, int] = {}
        first = start - below
        for j in range(max(first, 0), min(first + span, len(y))):
            places[columns[j]] = places.get(columns[j], 0) | 1 << (j - first)
        for unit in x[start : start + rows].tolist():
            equal = row & places.get(unit, 0)
            if equal:
                row = ((row + equal) | (row - equal)) & full
        so_far = matched + span - row.bit_count()
        if so_far + max(len(x) - start - rows, 0) < want:
            return 0
    return so_far


def key_of(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def sketches(docs: DataFrame) -> DataFrame:
    """(k, sketches) of every different text that has words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, found = [], []
            at = 0
            for texts in _portions(batch["text"].tolist()):
                for k, sequence in zip(batch["k"].iloc[at : at + len(texts)], shingles(texts)):
                    if len(sequence):
                        keys.append(k)
                        found.append(sketch(sequence).view(np.int64))
                at += len(texts)
            if keys:
                yield pd.DataFrame({"k": keys, "sketches": found})

    rows = docs.select(key_of(F.col("text")).alias("k"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(run, "k binary, sketches array<long>").dropDuplicates(["k"])


def buckets(found: DataFrame) -> DataFrame:
    """(b, k): every bucket of two or more different texts, with its size n."""
    s = lambda i: F.get("sketches", F.lit(i % SKETCHES))
    keys = [s(i) for i in range(SKETCHES)] + [F.xxhash64(s(i), s(i + 1)) for i in range(SKETCHES)]
    rows = found.select("k", F.explode(F.array(*keys)).alias("b"))
    sizes = rows.groupBy("b").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return rows.join(sizes, "b")


def hubs(members: DataFrame, weights: DataFrame) -> DataFrame:
    """(k, hub): every member with the member of its bucket whose sketches are shared most."""
    ranked = members.join(weights, "k")
    best = ranked.groupBy("b").agg(F.max(F.struct("weight", "k")).alias("best"))
    return members.join(best.select("b", F.col("best.k").alias("hub")), "b").where("k <> hub").select("b", "k", "hub")


def neighbours(members: DataFrame, open_: DataFrame, turn: int) -> DataFrame:
    """(b, k, hub): every open member with those before and after it in a random order of its bucket.

    Large buckets are dealt to parts first, so none is sorted in one task.
    """
    part = F.pmod(F.xxhash64("k", "b", F.lit(turn)), F.ceil(F.col("n") / PART_ROWS))
    order = Window.partitionBy("b", "part").orderBy(F.xxhash64("b", "k", F.lit(turn)), "k")
    flagged = members.join(open_.withColumn("open", F.lit(True)), ["b", "k"], "left")
    flagged = flagged.join(open_.select("b").distinct(), "b", "left_semi").withColumn("part", part)
    beside = flagged.withColumn("hubs", F.array(F.lag("k").over(order), F.lead("k").over(order))).where("open")
    return beside.select("b", "k", F.explode("hubs").alias("hub")).where("hub is not null")


def _may_hold(rows: DataFrame, wanted: DataFrame, key: str = "k") -> DataFrame:
    """The rows whose key may be among the wanted: a bit map of fixed size goes to every task.

    It has 2^18 words at any size of the tables; a full map only lets more rows through.
    """
    bit = F.pmod(F.xxhash64(key), F.lit(1 << 24))
    mask = F.expr("shiftleft(1L, cast(bit & 63 as int))")
    words = wanted.select(bit.alias("bit")).groupBy(F.expr("bit div 64").alias("word")).agg(F.bit_or(mask).alias("bits"))
    marked = rows.withColumn("bit", bit).withColumn("word", F.expr("bit div 64"))
    return marked.join(F.broadcast(words), "word").where(F.col("bits").bitwiseAND(mask) != 0).drop("bit", "word", "bits")


def sequences(docs: DataFrame, wanted: DataFrame, by: str = "shingles") -> DataFrame:
    """(k, words, n, profile) of the wanted texts; other texts and copies are left out before the shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = 0
            for texts in _portions(batch["text"].tolist()):
                rows = [packed(w) for w in words_of(texts)]
                own = [units(w, by) for w in rows]
                keys = batch["k"].iloc[at : at + len(texts)].tolist()
                yield pd.DataFrame({"k": keys, "words": rows, "n": [len(u) for u in own], "profile": [profile(u) for u in own]})
                at += len(texts)

    rows = docs.select(key_of(F.col("text")).alias("k"), F.coalesce("text", F.lit("")).alias("text"))
    rows = _may_hold(rows, wanted).dropDuplicates(["k"])
    return rows.join(wanted, "k").mapInPandas(run, "k binary, words array<int>, n int, profile binary")


def possible(pairs: DataFrame, found: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(k, hub) of the pairs whose lengths and profiles allow the similarity."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                most = most_matches(batch["profile"].tolist(), batch["other"].tolist())
                yield batch.loc[most >= batch["need"].to_numpy(), ["k", "hub"]]

    first = found.select("k", "n", "profile")
    other = found.select(F.col("k").alias("hub"), F.col("n").alias("m"), F.col("profile").alias("other"))
    need = F.ceil((F.col("n") + F.col("m")) * F.lit(least / (1 + least)) - 1e-9)
    rows = pairs.join(first, "k").join(other, "hub").withColumn("need", need).where("need <= least(n, m)")
    return rows.select("k", "hub", "profile", "other", "need").mapInPandas(run, "k binary, hub binary")


def verified(pairs: DataFrame, found: DataFrame, least: float = SIMILARITY, by: str = "shingles") -> DataFrame:
    """(k, hub, similarity) of the pairs that align well enough."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["similarity"] = [aligned(units(x, by), units(y, by), least) for x, y in zip(batch["words"], batch["other"])]
            yield batch.loc[batch["similarity"] > 0, ["k", "hub", "similarity"]]

    pairs = materialize(possible(pairs, found, least), "possible")
    words = found.select("k", "words")
    first = _may_hold(words, pairs.select("k"))
    other = _may_hold(words, pairs.select(F.col("hub").alias("k"))).toDF("hub", "other")
    return pairs.join(first, "k").join(other, "hub").select("k", "hub", "words", "other").mapInPandas(run, "k binary, hub binary, similarity double")


def _ordered(asked: DataFrame, *kept: str) -> DataFrame:
    return asked.select(*kept, F.greatest("k", "hub").alias("k"), F.least("k", "hub").alias("hub"))


def unsettled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(k, root): members of the buckets of three or more that hold several classes, as the roots tell.

    In a bucket of two the hub was compared with the other one.
    """
    rows = members.where("n > 2").join(roots.withColumnRenamed("node", "k"), "k", "left")
    rows = materialize(rows.select("b", "k", F.xxhash64(F.coalesce("root", "k")).alias("root")), "classes")
    several = rows.groupBy("b").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("b")
    return rows.join(several, "b", "left_semi").select("k", "root").distinct()


def frequent(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent labelled shingles of the texts, ascending, with their counts.

    All are counted; a table of counts by size gives the least count of those that are fetched.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            labels = [labelled(units(x, "shingles")).view(np.int64) for x in batch["words"]]
            if labels:
                label, n = np.unique(np.concatenate(labels), return_counts=True)
                yield pd.DataFrame({"label": label, "n": n})

    counts = texts.select("words").mapInPandas(run, "label long, n long").groupBy("label").agg(F.sum("n").alias("n")).where("n > 1")
    counts = materialize(counts, "label-counts")
    size = F.floor(F.log2("n") * 16).alias("size")  # under a thousand sizes
    total, lowest = 0, None
    for row in counts.groupBy(size).agg(F.count(F.lit(1)).alias("labels")).orderBy(F.desc("size")).collect():
        total += row["labels"]
        if total > FREQUENT:
            break
        lowest = row["size"]
    fetched = counts.where(size >= lowest) if lowest is not None else counts.limit(0)
    rows = fetched.toPandas().sort_values("label")
    return rows["label"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)


def prefixes(texts: DataFrame, label: np.ndarray, count: np.ndarray, least: float) -> DataFrame:
    """(label, k, root, at, n): the rarest labelled shingles of each text and their places in that order.

    A text of n shingles shares at least ``least`` * n with any that similar, so not all others are rarer.
    """
    label, count = np.append(label, np.iinfo(np.int64).max), np.append(count, 0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, held = [], 0
            for k, root, words in zip(batch["k"], batch["root"], batch["words"]):
                own = labelled(units(words, "shingles"))
                signed = own.view(np.int64)
                place = np.searchsorted(label, signed)
                often = np.where(label[place] == signed, count[place], 0)
                size = len(own) - int(np.ceil(least * len(own) - 1e-9)) + 1
                first = np.lexsort((mixed(own), often))[:size]
                rows.append(pd.DataFrame({"label": signed[first], "k": k, "root": root, "at": np.arange(len(first)), "n": len(own)}))
                held += len(first)
                if held > 100_000:
                    yield pd.concat(rows)
                    rows, held = [], 0
            if rows:
                yield pd.concat(rows)

    return texts.select("k", "root", "words").mapInPandas(run, "label long, k binary, root long, at int, n int")


def candidates(members: DataFrame, roots: DataFrame, payload: DataFrame, least: float) -> DataFrame:
    """(k, hub): all pairs of unsettled members of different classes that can be similar enough.

    Of the largest class of a key none is compared with its own; large keys are dealt to parts.
    """
    open_ = materialize(unsettled(members, roots), "unsettled")
    texts = materialize(payload.select("k", "words").join(open_, "k"), "unsettled-sequences")
    rows = materialize(prefixes(texts, *frequent(texts), least), "prefixes")
    shared = rows.groupBy("label").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("label")
    shared = materialize(shared, "shared-labels")
    rows = materialize(_may_hold(rows, shared, "label").join(shared, "label"), "shared-prefixes")
    kinds = rows.groupBy("label", "root").agg(F.count(F.lit(1)).alias("rows"))
    kinds = kinds.groupBy("label").agg(F.sum("rows").alias("rows"), F.max(F.struct("rows", "root"))["root"].alias("largest"))
    rows = rows.join(kinds, "label").withColumn("parts", F.ceil(F.col("rows") / PART_ROWS))
    rows = materialize(rows.select("label", "k", "root", "at", "n", "largest", "parts"), "keyed-prefixes")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    asking = rows.where("root <> largest").withColumn("part", every).drop("parts")
    part = F.pmod(F.xxhash64("k"), F.col("parts"))
    other = rows.select("label", part.alias("part"), F.col("k").alias("hub"), F.col("root").alias("other"), F.col("at").alias("other_at"), F.col("n").alias("m"))
    need = (F.col("n") + F.col("m")) * (least / (1 + least)) - 1e-9
    fits = need <= F.least(F.col("n") - F.col("at"), F.col("m") - F.col("other_at"))
    once = F.expr("root <> other and (other = largest or k > hub)")
    return asking.join(other, ["label", "part"]).where(once & fits).select("k", "hub")


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Sequences are long rows: batches of the usual size, and their copies, would fill an executor."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def links(docs: DataFrame, least: float = SIMILARITY, rounds: int = ROUNDS, by: str = "shingles") -> DataFrame:
    """(k, hub, similarity): verified links between different texts, by their keys (k > hub), stored."""
    with _small_batches(docs.sparkSession):
        found, _, more = _links(docs, least, rounds, by)
        return found.unionByName(more)


def classes(docs: DataFrame, least: float = SIMILARITY, rounds: int = ROUNDS, by: str = "shingles") -> DataFrame:
    """(node, root): the least key of its class, for every text with a link.

    The last search starts from the classes of the links before it; what it adds joins whole classes, so
    only their roots are closed again.
    """
    with _small_batches(docs.sparkSession):
        _, roots, more = _links(docs, least, rounds, by)
    return roots if more.isEmpty() else extended(roots, more, "k", "hub")


def _links(docs: DataFrame, least: float, rounds: int, by: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links by sketches, hubs and neighbours; (node, root) of these; links of the exact search. All stored."""
    members = materialize(buckets(sketches(docs)), "buckets")
    weights = materialize(members.groupBy("k").agg(F.sum("n").alias("weight")), "weights")
    asked = materialize(hubs(members.select("b", "k"), weights), "asked")
    open_ = asked.select("b", "k")
    found = docs.sparkSession.createDataFrame([], "k binary, hub binary, similarity double")
    tried, payload = found.select("k", "hub"), docs.sparkSession.createDataFrame([], "k binary, words array<int>, n int, profile binary")
    for turn in range(rounds):
        pairs = materialize(_ordered(asked).distinct().join(tried, ["k", "hub"], "left_anti"), "pairs")
        if pairs.isEmpty():
            break
        wanted = pairs.select("k").union(pairs.select("hub")).distinct().join(payload.select("k"), "k", "left_anti")
        payload = payload.unionByName(materialize(sequences(docs, materialize(wanted, "wanted"), by), "sequences"))
        found = found.unionByName(materialize(verified(pairs, payload, least, by), "links"))
        tried = tried.unionByName(pairs)
        if turn + 1 < rounds:
            # Members that none of those they were compared with in a bucket resembles stay open there.
            answered = asked.withColumns({"x": F.greatest("k", "hub"), "y": F.least("k", "hub")})
            linked = found.select(F.col("k").alias("x"), F.col("hub").alias("y"))
            matched = answered.join(linked, ["x", "y"], "left_semi").select("b", "k")
            open_ = materialize(open_.join(matched, ["b", "k"], "left_anti"), "open")
            asked = materialize(neighbours(members, open_, turn), "asked")
    roots = materialize(components(found, "k", "hub"), "roots")
    pairs = _ordered(candidates(members, roots, payload, least)).distinct().join(tried, ["k", "hub"], "left_anti")
    return found, roots, materialize(verified(materialize(pairs, "pairs"), payload, least, by), "links")


def text_classes(docs: DataFrame, least: float = SIMILARITY, rounds: int = ROUNDS, by: str = "shingles") -> DataFrame:
    """(k, root, doc_id, repeats, least, n) per different text: class, first id (null ids first) and rows
    with it, least id that is not null, rows with the text."""
    root = classes(docs, least, rounds, by)
    ids = docs.select(key_of(F.col("text")).alias("k"), "doc_id").groupBy("k", "doc_id").agg(F.count(F.lit(1)).alias("repeats"))
    texts = ids.groupBy("k").agg(F.min(F.struct("doc_id", "repeats")).alias("first"), F.min("doc_id").alias("least"), F.sum("repeats").alias("n"))
    joined = texts.join(root, texts["k"] == root["node"], "left")
    return joined.select("k", F.coalesce("root", "k").alias("root"), "first.doc_id", "first.repeats", "least", "n")


def near_duplicates(docs: DataFrame, least: float = SIMILARITY, rounds: int = ROUNDS, by: str = "shingles") -> DataFrame:
    """doc_id, class_id (least id of its class) and class_size (documents) of every row."""
    docs = docs.select("doc_id", "text")
    texts = materialize(text_classes(docs, least, rounds, by), "texts")
    sizes = texts.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("n").alias("class_size"))
    classes = texts.select("k", "root").join(sizes, "root").drop("root")
    return docs.select("doc_id", key_of(F.col("text")).alias("k")).join(classes, "k").select("doc_id", "class_id", "class_size")


def without_near_duplicates(docs: DataFrame, least: float = SIMILARITY, rounds: int = ROUNDS, by: str = "shingles") -> DataFrame:
    """One row of each class, the one with the least id; all columns kept."""
    texts = materialize(text_classes(docs.select("doc_id", "text"), least, rounds, by), "texts")
    first = texts.groupBy("root").agg(F.min(F.struct("doc_id", "k", "repeats")).alias("first")).select("first.*")
    kept = first.select(F.col("k").alias("_k"), F.col("doc_id").alias("_id"), F.col("repeats").alias("_repeats"))
    rows = docs.select(key_of(F.col("text")).alias("_key"), "doc_id", F.struct(*docs.columns).alias("_row"))
    rows = rows.join(kept, (rows["_key"] == kept["_k"]) & rows["doc_id"].eqNullSafe(kept["_id"]))
    once = rows.where("_repeats = 1").select("_row")
    repeated = rows.where("_repeats > 1").dropDuplicates(["_key", "doc_id"]).select("_row")
    return once.unionByName(repeated).select("_row.*")
