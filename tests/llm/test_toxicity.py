import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF
from tripkiln.llm import toxicity as tx


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    chain = tx.fit_toxicity(docs, labels.where(~held))
    got = tx.score_toxicity(docs, chain).join(labels.where(held).select("doc_id", "toxic").withColumnRenamed("toxic", "y"), "doc_id")
    rows = got.select("y", "toxic").collect()
    caught = [r["toxic"] for r in rows if r["y"]]
    clean = [r["toxic"] for r in rows if not r["y"]]
    assert np.mean(caught) > 0.8 and np.mean(clean) < 0.01


def test_chain_uses_out_of_fold_predictions_of_earlier_categories():
    rng = np.random.default_rng(0)
    n, d = 600, 40
    dense = rng.random((n, d)) < 0.2
    first = dense[:, 0]
    second = first ^ (rng.random(n) < 0.05)
    x = tx.Rows([np.flatnonzero(r).tolist() for r in dense], d)
    chain = tx.fit_chain(x, np.column_stack([first, second]), np.arange(n) % 5, ("a", "b"), [f"f{i}" for i in range(d)])
    assert [len(w) for w in chain.weights] == [d + 1, d + 2]
    p = chain.probabilities([np.flatnonzero(r).tolist() for r in dense])
    assert ((p[:, 0] > 0.5) == first).mean() > 0.99 and ((p[:, 1] > 0.5) == first).mean() > 0.97
    # the same by hand: odds of the first model enter the second
    w0, w1 = chain.weights
    odds = np.clip(dense @ w0[:-1] + w0[-1], -30, 30)
    by_hand = 1 / (1 + np.exp(-np.clip(dense @ w1[:d] + w1[d] * odds + w1[-1], -30, 30)))
    assert np.allclose(p[:, 1], by_hand)
    # out of fold: noise that a fitted model would remember does not help the second one
    noise = rng.random(n) < 0.5
    alone = tx.fit_chain(x, np.column_stack([noise, noise]), np.arange(n) % 5, ("a", "b"), [f"f{i}" for i in range(d)])
    assert alone.weights[1][d] < 0.5


def test_scoring_sees_what_training_saw(spark):
    chain = tx.Chain(["t"], ["bad", "^worsa", "^^evil"], [np.array([4.0, 2.0, 3.0, -1.0])])
    texts = ["bad", "BAD! worsable", "evila evilb", "evila evila", "good", "", None, "worsa-bad évilx"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["p_t"] for r in tx.score_toxicity(df, chain).collect()}
    for i, t in enumerate(texts):
        f = tx.text_features(t)
        odds = 4 * ("bad" in f) + 2 * ("^worsa" in f) + 3 * ("^^evil" in f) - 1
        assert np.isclose(got[i], 1 / (1 + np.exp(-odds)))


def test_threshold():
    y = np.array([1.0] * 60 + [0.0] * 200)
    p = np.concatenate([np.linspace(0.3, 0.9, 60), np.linspace(0.0, 0.1, 200)])
    assert tx.best_threshold(p, y) == pytest.approx(0.2)
    assert tx.best_threshold(p[30:], y[30:]) == tx.THRESHOLD  # too few toxic rows
    assert tx.best_threshold(np.full(260, 0.2), y) == tx.THRESHOLD  # nothing separates them
    noisy = np.concatenate([p[:60], np.linspace(0.0, 0.5, 200)])
    t = tx.best_threshold(noisy, y)
    assert (y[noisy >= t] > 0).mean() >= tx.PRECISION


def test_edge_rows(spark, edge_docs, no_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    odd = labels.select("doc_id", "toxic").unionByName(spark.createDataFrame([(None, 1), (0, None), (0, 0)], "doc_id long, toxic int"))
    chain = tx.fit_toxicity(docs, odd)
    got = tx.score_toxicity(edge_docs, chain)
    assert got.count() == edge_docs.count()
    assert set(got.columns) == {*edge_docs.columns, "p_insult", "p_dense"}
    assert not got.where("toxic").count()
    assert tx.score_toxicity(no_docs, chain).count() == 0
    for few in (odd.limit(0), odd.where("toxic = 0")):
        assert not tx.score_toxicity(docs, tx.fit_toxicity(docs, few)).where("toxic").count()
