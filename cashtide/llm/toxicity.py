"""Toxicity by weak supervision.

1. Lexicon: terms (words and word beginnings) of labelled rows, with the number of rows of each label
   that hold them once, twice or three times.
2. Voters: the most precise (term, times) pairs, general patterns (shouting, masked letters, ...) and
   the annotator, whose labels are only one more opinion with an accuracy of its own.
3. Label model: a generative model of the votes given the true label.  Accuracies and the strongest
   correlations (a maximum spanning tree of the conditional mutual information) are estimated by
   expectation maximisation, so voters that repeat each other do not count twice.
4. A logistic regression over term counts learns the posterior labels and scores any text.

Steps 2 to 4 run on the driver over at most ``max_labelled`` rows, a documented bound: a fixed share
of the ids by hash, at any size of the table.  Everything else is distributed: term counts are added
up in the tasks before the one shuffle, and scoring is a map with a model of ``features`` terms.

Defined cases: a null text is an empty one; empty texts get the score of the intercept; labels of a
document that disagree or are null are not learned from; without labels of both kinds every score is
0.0; repeated rows get equal scores; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LABELLED = 20_000
FEATURES = 3_000
VOTERS = 48
TIMES = (1, 2, 3)
BEGINNINGS = (4, 5, 6, 7)
MIN_ROWS = 5
PRECISION = 0.6  # lower confidence bound from which a term may vote
TRUST = 0.9  # the annotator is right at least so often, for rows of either label
PATTERNS = {
    "shouting": r"!{2,}",
    "capitals": r"\b[A-Z]{4,}\b",
    "masked": r"[*#$%&@]{3,}",
    "stretched": r"(\w)\1{3,}",
    "questions": r"\?{2,}",
}
_WORD = re.compile(r"\w+")
_NOT_WORD = re.compile(r"\W+")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def terms_of(text: str) -> Counter:
    """Words (closed by a blank) and word beginnings, with their number."""
    found: Counter = Counter()
    for word, times in Counter(_WORD.findall(text.lower())).items():
        found[word + " "] += times
        for n in BEGINNINGS:
            if len(word) > n:
                found[word[:n]] += times
    return found


def learning_rows(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(text, label): labelled rows that are not held out, about ``max_labelled`` at most."""
    agreed = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min(label).alias("label"), F.max(label).alias("_max"))
        .where("label = _max")
        .drop("_max")
    )
    total = agreed.count()
    if total > max_labelled:
        share = int(1_000_000 * max_labelled / total)
        agreed = agreed.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share)
    text = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    # The ids are bounded by max_labelled, so they may be sent to every task; the texts stay in place.
    return text.join(F.broadcast(agreed), "doc_id").select("text", F.col("label").cast("int").alias("label"))


def term_counts(rows: DataFrame) -> DataFrame:
    """(term, t1..t3, c1..c3): toxic and clean rows that hold the term at least 1, 2, 3 times."""
    names = [f"{kind}{n}" for kind in "tc" for n in TIMES]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for text, label in zip(batch["text"], batch["label"]):
                for term, times in terms_of(text).items():
                    row = seen.setdefault(term, [0] * 6)
                    for n in TIMES[: min(times, 3)]:
                        row[n - 1 if label else n + 2] += 1
            table = np.array(list(seen.values()), np.int64).reshape(-1, 6)
            yield pd.DataFrame({"term": list(seen)} | {n: table[:, i] for i, n in enumerate(names)})

    schema = "term string, " + ", ".join(f"{n} long" for n in names)
    return rows.mapInPandas(count, schema).groupBy("term").agg(*(F.sum(n).alias(n) for n in names))


def _automaton(terms: list[str]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        automaton.add_word(" " + term, i)
    automaton.make_automaton()
    return automaton


def term_vector(text: str, automaton: ahocorasick.Automaton) -> Counter:
    """Number of each chosen term: word beginnings, or whole words where the term ends in a blank."""
    plain = f" {_NOT_WORD.sub(' ', text.lower())} "
    return Counter(i for _, i in automaton.iter(plain)) if len(automaton) else Counter()


@dataclass
class LabelModel:
    """P(votes, label): each voter given the label and the voter before it in a tree.

    A lexicon or pattern voter that is silent abstains: rows differ in language and subject, so silence
    tells nothing about the label.  The annotator (the last voter) always votes.
    """

    prior: float
    parents: np.ndarray  # -1 for the root and for voters without a strong partner
    tables: np.ndarray  # [voter, label, vote of the parent, vote] -> probability

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        score = np.tile(np.log([1 - self.prior, self.prior]), (len(votes), 1))
        for j, parent in enumerate(self.parents):
            before = votes[:, parent] if parent >= 0 else np.zeros(len(votes), np.int64)
            speaks = (votes[:, j] == 1) | (j == votes.shape[1] - 1)
            for label in (0, 1):
                score[:, label] += np.where(speaks, np.log(self.tables[j, label, before, votes[:, j]]), 0)
        return 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -500, 500)))


def _fit_tables(votes: np.ndarray, weight: np.ndarray, parents: np.ndarray, prior: float) -> LabelModel:
    count = votes.shape[1]
    tables = np.empty((count, 2, 2, 2))
    for j, parent in enumerate(parents):
        before = votes[:, parent] if parent >= 0 else np.zeros(len(votes), np.int64)
        for label in (0, 1):
            own = weight if label else 1 - weight
            alone = np.bincount(votes[:, j], own, 2) + 0.1
            # Where the parent's vote is rare, the voter's own rate fills in.
            seen = np.bincount(before * 2 + votes[:, j], own, 4).reshape(2, 2) + 2 * alone / alone.sum()
            tables[j, label] = seen / seen.sum(1, keepdims=True)
            if j == count - 1:
                wrong = min(tables[j, label, 0, 1 - label], 1 - TRUST)
                tables[j, label, :, 1 - label], tables[j, label, :, label] = wrong, 1 - wrong
    return LabelModel(prior, parents, tables)


def _tree(votes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Parents in a maximum spanning tree of the mutual information given the label."""
    count, total = votes.shape[1], len(votes)
    information = np.zeros((count, count))
    for own in (weight, 1 - weight):
        mass = max(own.sum(), 1e-9)
        x = votes.astype(float)
        both = (x * own[:, None]).T @ x / mass
        one = np.diag(both)
        for a in (0, 1):
            for b in (0, 1):
                pa, pb = (one if a else 1 - one)[:, None], (one if b else 1 - one)[None, :]
                joint = both if a and b else one[:, None] - both if a else one[None, :] - both if b else 1 - one[:, None] - one[None, :] + both
                joint = np.clip(joint, 1e-12, 1)
                information += mass / total * joint * np.log(joint / np.clip(pa * pb, 1e-12, 1))
    parents, best, near = np.full(count, -1), np.full(count, -np.inf), np.full(count, -1)
    inside = np.zeros(count, bool)
    at = 0
    for _ in range(count):
        inside[at] = True
        closer = ~inside & (information[at] > best)
        best[closer], near[closer] = information[at][closer], at
        if inside.all():
            break
        at = int(np.argmax(np.where(inside, -np.inf, best)))
        parents[at] = near[at] if best[at] > 1 / total else -1
    return parents


def fit_label_model(votes: np.ndarray, start: np.ndarray, rounds: int = 30) -> LabelModel:
    """Expectation maximisation from the posteriors ``start``.

    Correlations come first, or voters that repeat each other would draw the labels to themselves.
    The share of toxic rows is the annotator's and stays fixed.
    """
    weight = start.astype(float)
    prior = float(np.clip(votes[:, -1].mean(), 1e-4, 1 - 1e-4))
    for _ in range(2):
        # The annotator reads the text, not the other voters.
        parents = np.append(_tree(votes[:, :-1], weight), -1)
        for _ in range(rounds):
            moved = _fit_tables(votes, weight, parents, prior).posterior(votes)
            change = np.abs(moved - weight).max(initial=0)
            weight = moved
            if change < 1e-4:
                break
    return _fit_tables(votes, weight, parents, prior)


def fit_linear(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, target: np.ndarray, width: int, ridge: float = 2.0, rounds: int = 400):
    """Weights and intercept of a logistic regression on soft labels (sparse rows, Nesterov steps)."""
    count = len(target)
    weights = look = np.zeros(width + 1)
    weights[width] = np.log((target.mean() + 1e-4) / (1 - target.mean() + 1e-4))
    # Columns differ in mass by orders of magnitude: each gets its own step length.
    mass = np.bincount(columns, values * values, width) * 0.25 * max(1.0, np.bincount(rows, minlength=count).max(initial=1) ** 0.5)
    step = 1 / np.append(mass + ridge, 0.25 * count * 4)
    for k in range(rounds):
        score = np.bincount(rows, values * look[columns], count) + look[width]
        error = 1 / (1 + np.exp(-np.clip(score, -500, 500))) - target
        gradient = np.append(np.bincount(columns, values * error[rows], width) + ridge * look[:width], error.sum())
        moved = look - step * gradient
        look = moved + k / (k + 3) * (moved - weights)
        weights = moved
    return weights[:width], float(weights[width])


@dataclass
class Classifier:
    terms: list[str]
    weights: np.ndarray
    intercept: float

    def scores(self, texts) -> np.ndarray:
        automaton = _cached_automaton(tuple(self.terms))
        out = np.empty(len(texts))
        for n, text in enumerate(texts):
            found = term_vector(text or "", automaton)
            out[n] = self.intercept + sum(self.weights[i] * np.log1p(times) for i, times in found.items())
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


@lru_cache(maxsize=2)
def _cached_automaton(terms: tuple[str, ...]) -> ahocorasick.Automaton:
    return _automaton(list(terms))


def _votes(found: list[Counter], patterns: np.ndarray, label: np.ndarray, chosen: list[tuple[int, int]]) -> np.ndarray:
    votes = np.zeros((len(found), len(chosen) + patterns.shape[1] + 1), np.int64)
    for n, counts in enumerate(found):
        votes[n, : len(chosen)] = [counts.get(term, 0) >= times for term, times in chosen]
    votes[:, len(chosen) : -1] = patterns
    votes[:, -1] = label
    return votes


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_labelled: int = MAX_LABELLED, features: int = FEATURES) -> Classifier | None:
    """The classifier; None where the labels are not of both kinds."""
    rows = learning_rows(docs, labels, label, max_labelled)
    size = rows.groupBy("label").count().collect()
    number = {r["label"]: r["count"] for r in size}
    if not (number.get(0) and number.get(1)):
        return None
    toxic, clean = number[1], number[0]
    counts = term_counts(rows)
    for n in TIMES:
        t, c = F.col(f"t{n}") + 0.5, F.col(f"c{n}") + 0.5
        z = F.abs(F.log(t * (clean + 1) / (c * (toxic + 1)))) / F.sqrt(1 / t + 1 / c)
        counts = counts.withColumn(f"z{n}", z)
    counts = counts.where(f"t1 + c1 >= {MIN_ROWS}").withColumn("z", F.greatest("z1", "z2", "z3"))
    lexicon = counts.orderBy(F.desc("z"), "term").limit(features).toPandas()
    terms = lexicon["term"].tolist()

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = _automaton(terms)
        compiled = [re.compile(p) for p in PATTERNS.values()]
        for batch in batches:
            found = [sorted(term_vector(t, automaton).items()) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "label": batch["label"],
                    "columns": [[i for i, _ in x] for x in found],
                    "times": [[n for _, n in x] for x in found],
                    "patterns": [[int(p.search(t) is not None) for p in compiled] for t in batch["text"]],
                }
            )

    schema = "label int, columns array<int>, times array<int>, patterns array<int>"
    sample = rows.mapInPandas(vectors, schema).toPandas()
    found = [Counter(dict(zip(c, t))) for c, t in zip(sample["columns"], sample["times"])]
    chosen = _voters(lexicon, toxic, clean)
    target = sample["label"].to_numpy(np.int64)
    votes = _votes(found, np.array(sample["patterns"].tolist(), np.int64).reshape(len(found), -1), target, chosen)
    model = fit_label_model(votes, np.where(target == 1, 0.9, 0.1))
    posterior = model.posterior(votes)
    lengths = np.array([len(c) for c in sample["columns"]])
    at = np.repeat(np.arange(len(lengths)), lengths)
    columns = np.concatenate([*sample["columns"], np.zeros(0)]).astype(np.int64)
    times = np.log1p(np.concatenate([*sample["times"], np.zeros(0)]).astype(float))
    weights, intercept = fit_linear(at, columns, times, posterior, len(terms))
    return Classifier(terms, weights, intercept)


def _voters(lexicon: pd.DataFrame, toxic: int, clean: int, most: int = VOTERS) -> list[tuple[int, int]]:
    """(term, times): precise pairs with much support first; of terms that begin alike only the best."""
    pairs = []
    for n in TIMES:
        t, c = lexicon[f"t{n}"].to_numpy(float), lexicon[f"c{n}"].to_numpy(float)
        lower = (t + 1) / (t + c + 2) - 1.64 * np.sqrt((t + 1) * (c + 1) / (t + c + 2) ** 2 / (t + c + 3))
        pairs += [(lower[i], t[i], i, n) for i in np.flatnonzero((t >= MIN_ROWS) & (lower > PRECISION))]
    terms, chosen = [t.strip() for t in lexicon["term"]], []
    for _, _, i, n in sorted(pairs, key=lambda p: (-p[0] * p[1] ** 0.5, -len(terms[p[2]]), p[2], p[3])):
        alike = any(n == m and (terms[i].startswith(terms[j]) or terms[j].startswith(terms[i])) for j, m in chosen)
        if not alike and len(chosen) < most:
            chosen.append((int(i), n))
    return chosen


def scored(docs: DataFrame, model: Classifier | None) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.scores(texts))

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), (score(text) if model else F.lit(0.0)).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, model: Classifier | None) -> DataFrame:
    """The rows whose text is not predicted toxic, all columns kept."""
    if model is None:
        return docs

    @F.pandas_udf("boolean")
    def toxic(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.scores(texts) >= 0.5)

    return docs.where(~toxic(F.coalesce(F.col("text"), F.lit(""))))
