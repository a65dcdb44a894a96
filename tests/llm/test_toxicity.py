import numpy as np
from odd_rows import ODD, docs_of

from cashtide.llm import toxicity as tx

MIDDLE = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    found = tx.scored(docs, tx.train(docs, labels))
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert found.count() == docs.count() and len(rows) > 50
    right = np.mean([r.predicted == r.toxic for r in rows])
    wrong = [r for r in rows if r.predicted and not r.toxic]
    assert right >= 0.93 and not wrong
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_label_model_discounts_voters_that_repeat_each_other():
    random = np.random.default_rng(5)
    truth = random.random(4_000) < 0.3
    good = np.where(random.random(4_000) < 0.8, truth, False).astype(np.int64)
    weak = (random.random(4_000) < np.where(truth, 0.5, 0.3)).astype(np.int64)
    annotator = np.where(random.random(4_000) < 0.9, truth, ~truth).astype(np.int64)
    votes = np.stack([good, weak, weak, weak, weak, annotator], axis=1)
    model = tx.fit_label_model(votes, np.where(annotator == 1, 0.9, 0.1))
    assert (model.parents[1:5] >= 0).sum() >= 3  # the copies are tied to each other
    posterior = model.posterior(votes)
    assert np.mean((posterior >= 0.5) == truth) > np.mean(annotator == truth)


def test_linear_classifier_learns_soft_labels():
    random = np.random.default_rng(1)
    x = random.integers(0, 2, (2_000, 5))
    chance = 1 / (1 + np.exp(-(x @ np.array([3, -2, 0, 0, 1]) - 1)))
    rows, columns = np.nonzero(x)
    weights, intercept = tx.fit_linear(rows, columns, np.ones(len(rows)), chance, 5, ridge=0.01, rounds=3_000)
    assert np.abs(weights - [3, -2, 0, 0, 1]).max() < 0.2 and abs(intercept + 1) < 0.2


def test_odd_rows(spark):
    docs = docs_of(spark, ODD)
    labels = spark.createDataFrame([(1, 1, None), (1, 1, None), (2, 0, 1), (3, 1, 0), (3, 1, 1)], "doc_id long, quality int, toxic int")
    assert tx.train(docs, labels) is None  # one agreed label is not enough
    assert {(r.score, r.predicted) for r in tx.scored(docs, None).collect()} == {(0.0, 0)}
    assert tx.without_toxic(docs, None).count() == len(ODD)
    model = tx.Classifier(["bad "], np.array([5.0]), -2.0)
    scores = {(r.doc_id, r.score >= 0.5) for r in tx.scored(docs_of(spark, [*ODD, (9, "A BAD, word")]), model).collect()}
    assert (9, True) in scores and (1, False) in scores and (None, False) in scores
    kept = tx.without_toxic(docs_of(spark, [*ODD, (9, "A BAD, word")]), model)
    assert kept.count() == len(ODD) and kept.columns == docs.columns
    assert tx.scored(docs.limit(0), model).count() == 0
