"""Toxicity by a classifier chain.

One linear (logistic) model a category, in a fixed order; each model sees a
text's words and the probabilities of the categories before it. In training
those are out-of-fold predictions, so a later model learns from earlier
probabilities as good as it will get them, not from fitted ones.

Features are whole words, word beginnings, and beginnings that several words
of the text share, chosen by a chi-squared test. The fit reads a bounded sample of labelled rows
(``TRAIN_ROWS``), whose rows weigh as much as the labelled rows they stand for;
the scoring reads every whole text once, with no shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripkiln.llm.common import fresh, small_batches, stage, table

#: Labelled rows that the fit reads at most, a quarter of them toxic if there are as many; they weigh as the rows they are drawn from.
TRAIN_ROWS = 24_000
N_FEATURES = 1024
#: Texts whose features are held together in a task.
COUNTED_TEXTS = 400
#: Gradient steps of one fit.
STEPS = 80
L2 = 1e-3
FOLDS = 5
THRESHOLD = 0.5
#: The threshold follows the out-of-fold predictions from so many toxic rows on.
TELLING_ROWS = 50
PRECISION = 0.95
PREFIXES = (4, 5)
#: Words of a document beyond which a mark in so many makes a toxic text a dense one.
DENSE_WORDS = 60
#: A word is an insult if it stands in toxic texts nearly alone and in this share of them.
INSULT_SHARE = 0.02
#: Share of toxic texts among those with a mark.
MARK_PRECISION = 0.9
CATEGORIES = ("insult", "dense", "toxic")
_WORD = re.compile(r"[^\W\d_]+")


def text_features(text: str | None) -> set[str]:
    """Distinct lower-case words, their beginnings (marked ``^``), and the
    beginnings of two or more of them (marked ``^^``)."""
    words = set(_WORD.findall((text or "").lower()))
    out = set(words)
    for n in PREFIXES:
        starts = Counter([w[:n] for w in words if len(w) >= n])
        out.update(["^" + s for s in starts])
        out.update(["^^" + s for s, k in starts.items() if k > 1])
    return out


class Rows:
    """0/1 feature rows, sparse, with a few dense columns behind them."""

    def __init__(self, rows: Sequence[Sequence[int]], n_features: int):
        counts = np.fromiter(map(len, rows), np.int64, len(rows))
        self.flat = np.fromiter((i for r in rows for i in r), np.int64, int(counts.sum()))
        self.owner = np.repeat(np.arange(len(rows)), counts)
        self.n, self.d, self.dense = len(rows), n_features, np.empty((len(rows), 0))

    def where(self, mask: np.ndarray) -> Rows:
        out = Rows([], self.d)
        inside = mask[self.owner]
        out.flat, out.owner = self.flat[inside], (np.cumsum(mask) - 1)[self.owner[inside]]
        out.n, out.dense = int(mask.sum()), self.dense[mask]
        return out

    def plus(self, column: np.ndarray) -> Rows:
        out = Rows([], self.d)
        out.flat, out.owner, out.n = self.flat, self.owner, self.n
        out.dense = np.column_stack([self.dense, column])
        return out

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, weights=w[self.flat], minlength=self.n) + self.dense @ w[self.d : self.d + self.dense.shape[1]]

    def gathered(self, g: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(self.flat, weights=g[self.owner], minlength=self.d), self.dense.T @ g)

    def odds(self, w: np.ndarray) -> np.ndarray:
        return np.clip(self.times(w) + w[-1], -30, 30)


@dataclass
class Chain:
    """The fitted models: ``weights[c]`` has a weight a feature, one for each
    earlier category's log-odds, and the bias."""

    categories: list[str]
    features: list[str]
    weights: list[np.ndarray]
    threshold: float = THRESHOLD

    def probabilities(self, rows: Sequence[Sequence[int]]) -> np.ndarray:
        """One row a text (its feature numbers), one column a category."""
        x, odds = Rows(rows, len(self.features)), []
        for w in self.weights:
            odds.append(x.odds(w))
            x = x.plus(odds[-1])
        return 1 / (1 + np.exp(-np.array(odds).reshape(len(self.weights), len(rows)).T))


def fit_logistic(x: Rows, y: np.ndarray, l2: float = L2, steps: int = STEPS, weight: np.ndarray | None = None) -> np.ndarray:
    """Weights (bias last) of a ridge logistic regression by accelerated
    gradient steps; ``weight``: how many rows each row stands for. One class
    only: the bias says so, all weights are 0."""
    d = x.d + x.dense.shape[1]
    if not x.n or y.min() == y.max():
        w = np.zeros(d + 1)
        w[-1] = 8.0 if x.n and y.any() else -8.0
        return w
    weight = np.ones(x.n) if weight is None else weight * (x.n / weight.sum())
    # rare features count as much as common ones: columns are scaled to equal power
    power = np.append(np.bincount(x.flat, weights=weight[x.owner], minlength=x.d), weight @ x.dense**2) / x.n
    scale = 1 / np.sqrt(power + 1 / x.n)
    v = np.ones(d)
    for _ in range(8):  # the largest curvature, for the step length
        v = scale * x.gathered(weight * x.times(scale * v))
        v /= max(np.linalg.norm(v), 1e-12)
    step = 1 / (0.25 * (float(weight @ x.times(scale * v) ** 2) / x.n + 1) + l2)
    scale = np.append(scale, 1.0)
    w = at = np.zeros(d + 1)
    t = 1.0
    for _ in range(steps):
        miss = weight * (1 / (1 + np.exp(-x.odds(scale * at))) - y)
        g = scale * np.append(x.gathered(miss) / x.n, miss.mean())
        g[:-1] += l2 * at[:-1]
        after, t_after = at - step * g, (1 + np.sqrt(1 + 4 * t * t)) / 2
        at = after + (t - 1) / t_after * (after - w)
        w, t = after, t_after
    return scale * w


def best_threshold(p: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> float:
    """The probability between two rows that separates the classes with the
    largest F score (beta 0.5: losing a clean row weighs more) at a precision
    of ``PRECISION`` or more, each row counting for ``weight`` rows;
    ``THRESHOLD`` where the rows are too few to tell or nothing separates them
    so well."""
    if y.sum() < TELLING_ROWS:
        return THRESHOLD
    order = np.argsort(-p, kind="stable")
    taken = np.arange(1.0, len(p) + 1) if weight is None else np.cumsum(weight[order])
    p, hits = p[order], np.cumsum(y[order] if weight is None else (y * weight)[order])
    apart = np.append(p[:-1] > p[1:], True)  # equal probabilities stay together
    score = np.where(apart & (hits >= PRECISION * taken), 1.25 * hits / (taken + 0.25 * hits[-1]), 0)
    k = int(np.argmax(score))
    if not score[k]:
        return THRESHOLD
    after = p[k + 1] if k + 1 < len(p) else 0.0
    return float(np.clip((p[k] + after) / 2, 0.02, 0.98))


def fit_chain(
    x: Rows, labels: np.ndarray, folds: np.ndarray, categories: Sequence[str], features: list[str], weight: np.ndarray | None = None
) -> Chain:
    """Category by category: the model over all rows is kept, the models over
    all folds but one give the log-odds that later categories train on, and
    those of the last category its threshold."""
    weights, threshold = [], THRESHOLD
    for c in range(labels.shape[1]):
        y = labels[:, c].astype(np.float64)
        weights.append(fit_logistic(x, y, weight=weight))
        out = np.zeros(len(y))
        for k in np.unique(folds):
            inside = folds != k
            part = None if weight is None else weight[inside]
            out[~inside] = x.where(~inside).odds(fit_logistic(x.where(inside), y[inside], weight=part))
        if c + 1 < labels.shape[1]:
            x = x.plus(out)
        elif y.any():
            threshold = best_threshold(1 / (1 + np.exp(-out)), y, weight)
    return Chain(list(categories), features, weights, threshold)


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, COUNTED_TEXTS):
            part = batch.slice(at, COUNTED_TEXTS)
            all_, positive = Counter(), Counter()
            for text, y in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                found = text_features(text)
                all_.update(found)
                if y:
                    positive.update(found)
            keys = list(all_)
            counts = [pa.array([c[k] for k in keys], pa.int64()) for c in (all_, positive)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *counts], names=["feature", "n", "pos"])


def training_rows(docs: DataFrame, labels: DataFrame, rows: int, id_col: str, text_col: str) -> tuple[DataFrame, dict[bool, float]]:
    """At most ``rows`` labelled texts ``(id, text, y)``, up to a quarter of
    them toxic, by a hash of the id, and for how many labelled rows a toxic
    and a clean one of them stand. Ids that repeat in ``labels`` with different
    labels count as toxic if any does; null labels and ids are left out."""
    one = labels.where(F.col("y").isNotNull() & F.col("id").isNotNull()).groupBy("id").agg(
        *[F.max(c).alias(c) for c in labels.columns if c != "id"]
    )
    order = F.xxhash64(F.lit(1), "id")
    most = {True: rows // 4, False: rows - rows // 4}
    picked = one.where("y > 0").orderBy(order, "id").limit(most[True]).unionByName(one.where("y <= 0").orderBy(order, "id").limit(most[False]))
    stands_for = {r["toxic"]: max(1.0, r["n"] / max(1, most[r["toxic"]])) for r in one.groupBy((F.col("y") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    picked = stage(picked, "picked")  # bounded by rows: broadcast
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # a repeated document counts once
    return stage(texts.join(F.broadcast(picked), "id").dropDuplicates(["id"]), "train"), stands_for


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
    train_rows: int = TRAIN_ROWS, n_features: int = N_FEATURES,
) -> Chain:
    """Fit the chain on ``labels(id_col, label)`` (0/1) of ``docs``.

    The label says toxic or not; the two categories before it are read off
    the labelled texts, whatever their language. Marks are chosen features that
    are found in toxic texts nearly alone (``MARK_PRECISION``); ``insult``: toxic,
    with a whole word that is a mark and stands in ``INSULT_SHARE`` of the toxic
    texts (two at least); ``dense``: toxic, with more than one mark in
    ``DENSE_WORDS`` words. Without a labelled text of both classes nothing is
    toxic."""
    small_batches(docs.sparkSession)
    slim = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y"))
    train, stands_for = training_rows(docs, slim, train_rows, id_col, text_col)
    sizes = {int(r["y"] > 0): r["n"] for r in train.groupBy((F.col("y") > 0).cast("int").alias("y")).agg(F.count("*").alias("n")).collect()}
    n_pos, n_neg = sizes.get(1, 0), sizes.get(0, 0)
    if not n_pos or not n_neg:
        return Chain(list(CATEGORIES), [], [np.array([*[0.0] * c, -8.0]) for c in range(len(CATEGORIES))])
    counts = (
        train.select("text", (F.col("y") > 0).alias("y")).mapInArrow(_feature_counts, "feature string, n long, pos long")
        .groupBy("feature").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    )
    total = float(n_pos + n_neg)
    have, rate = F.col("n").cast("double"), F.lit(n_pos / total)
    chi2 = F.pow(F.col("pos") - have * rate, 2) / (have * rate * (1 - rate) * (1 - (have - 1) / total))
    top = counts.where("n >= 2").withColumn("chi2", chi2).orderBy(F.desc("chi2"), "feature").limit(n_features).collect()
    features = sorted(r["feature"] for r in top)
    number = {f: i for i, f in enumerate(features)}
    share = stands_for[True] / stands_for[False]
    marked = {r["feature"] for r in top if r["pos"] * share > MARK_PRECISION * (r["pos"] * share + r["n"] - r["pos"])}
    insults = {r["feature"] for r in top if r["feature"] in marked and r["feature"][0] != "^" and r["pos"] >= max(2, INSULT_SHARE * n_pos)}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = [bool(y and y > 0) for y in batch.column(2).to_pylist()]
            rows, insult, dense = [], [], []
            for text, y in zip(batch.column(1), toxic):  # one text's features at a time
                found = text_features(text.as_py())
                rows.append(sorted(number[f] for f in found if f in number))
                insult.append(y and not found.isdisjoint(insults))
                dense.append(y and len(marked & found) * DENSE_WORDS > len(_WORD.findall(text.as_py() or "")))
            columns = [batch.column(0), pa.array(rows, pa.list_(pa.int32())), *map(pa.array, (insult, dense, toxic))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "features", *CATEGORIES])

    id_type = dict(train.dtypes)["id"]
    fields = ", ".join(f"{c} boolean" for c in CATEGORIES)
    sample = train.select("id", "text", "y").mapInArrow(vectors, f"id {id_type}, features array<int>, {fields}")
    # bounded: train_rows rows of at most n_features small integers
    got = sample.withColumn("fold", F.pmod(F.xxhash64(F.lit(2), "id"), F.lit(FOLDS))).orderBy("id").collect()
    x = Rows([r["features"] for r in got], len(features))
    y = np.array([[r[c] for c in CATEGORIES] for r in got], bool)
    weight = np.where(y[:, -1], stands_for[True], stands_for[False])
    return fit_chain(x, y, np.array([r["fold"] for r in got]), CATEGORIES, features, weight)


def score_udf(chain: Chain):
    number = {f: i for i, f in enumerate(chain.features)}
    words_known = {f: i for f, i in number.items() if f[0] != "^"}
    begins = {f.lstrip("^") for f in number if f[0] == "^"}
    fields = T.StructType([T.StructField(f"p_{c}", T.DoubleType()) for c in chain.categories])

    def feature_numbers(text: str | None) -> list[int]:
        """As ``text_features``, for the chosen features only."""
        words = set(_WORD.findall((text or "").lower()))
        found = [words_known[w] for w in words & words_known.keys()]
        for n in PREFIXES:
            starts = Counter([s for s in [w[:n] for w in words if len(w) >= n] if s in begins])
            found += [number["^" + s] for s in starts if "^" + s in number]
            found += [number["^^" + s] for s, k in starts.items() if k > 1 and "^^" + s in number]
        return found

    @F.arrow_udf(fields)
    def score(texts: pa.Array) -> pa.Array:
        found = [np.empty((0, len(fields)))]
        for at in range(0, len(texts), COUNTED_TEXTS):  # one text's words at a time
            found.append(chain.probabilities([feature_numbers(t.as_py()) for t in texts.slice(at, COUNTED_TEXTS)]))
        p = np.concatenate(found)
        return pa.StructArray.from_arrays([pa.array(p[:, i]) for i in range(len(fields))], names=fields.names)

    return score


def score_toxicity(docs: DataFrame, chain: Chain, text_col: str = "text", threshold: float | None = None) -> DataFrame:
    """``docs`` with ``p_<category>`` and ``toxic`` (the last category's
    probability reaches ``threshold``, the chain's own unless given); columns of these names are replaced.
    Null and empty texts have no features and are judged by the bias alone;
    every row gets its own answer, so repeated rows agree."""
    small_batches(docs.sparkSession)
    new = [f"p_{c}" for c in chain.categories] + ["toxic"]
    keep = [c for c in docs.columns if c.lower() not in new]
    (p,) = fresh(keep + new, "p")
    scored = docs.select(*keep, score_udf(chain)(F.col(text_col)).alias(p))
    last = F.col(p)[f"p_{chain.categories[-1]}"]
    return scored.select(*keep, *[F.col(p)[c].alias(c) for c in new[:-1]], (last >= (chain.threshold if threshold is None else threshold)).alias("toxic"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, chain).select("doc_id", *[f"p_{c}" for c in CATEGORIES], "toxic")
