import numpy as np
import pytest
from pyspark.sql import functions as F

from tripkiln.llm import ann


def _brute(ids, x, queries, k=10):
    out = {}
    for q in queries:
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, d)) if i != q][:k]
        out[int(ids[q])] = [(int(ids[i]), d[i]) for i in order]
    return out


@pytest.mark.parametrize("sf, block", [("sf0.01", ann.BLOCK_ROWS), ("sf0.1", 600)])
def test_recall_and_scores(spark, sf, block):
    table = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = table.orderBy("vec_id").collect()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], np.float64)
    want = _brute(ids, x, np.flatnonzero(ids % 100 == 0))
    got = {}
    for r in ann.nearest_neighbours(table, F.col("vec_id") % 100 == 0, block_rows=block).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
    at = {int(v): i for i, v in enumerate(ids)}
    hits = 0
    for q, found in got.items():
        assert [r for _, _, r in found] == list(range(1, 11))
        for v, score, _ in found:
            assert score == pytest.approx(np.sqrt(((x[at[v]] - x[at[q]]) ** 2).sum()), rel=1e-14)
        hits += len({v for v, _, _ in found} & {v for v, _ in want[q]})
    assert set(got) == set(want) and hits / (10 * len(want)) >= 0.9


def test_forest_prefers_longer_prefixes():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((6000, 32)).astype(np.float32)
    near = x[7] + 0.05 * rng.standard_normal((20, 32)).astype(np.float32)
    forest = ann.Forest(np.vstack([x, near]), 16, 4, 1)
    spans = forest.prefix_ranges(x[7:8])
    few = forest.candidates(spans[:, :, 0], 10)
    assert len(few) < 600 and {6000 + i for i in range(20)} <= set(few.tolist())
    assert len(forest.candidates(spans[:, :, 0], 6020)) == 6020  # up to the root
    for order, strings in zip(forest.order, forest.strings):
        assert (np.diff(strings) >= 0).all() and len(order) == 6020


def test_copies_ties_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(300)] + [(300, [0.0, 1.0]), (301, [0.0, -1.0]), (100, [1.0, 0.0])]
    rows += [(400, None), (500, [0.0, 0.0]), (600, [nan, 1.0]), (700, [inf, 1.0]), (800, [None, 1.0]), (900, [1.0, 0.0, 0.0]), (None, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x"))
    got = ann.nearest_neighbours(df, F.col("vec_id") % 100 == 0, block_rows=50).collect()
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(by) == {0, 100, 200, 300}  # 900 is alone in its dimension
    assert sorted(by[0]) == [(k, k, 0.0) for k in range(1, 11)]
    assert sorted(by[200]) == [(k + 1, k, 0.0) for k in range(10)]
    assert sorted(by[300]) == [(k + 1, k, pytest.approx(2**0.5)) for k in range(10)]
    assert len(by[100]) == 20  # two rows with one id ask, and each is the other's neighbour only by its id's place
    assert ann.nearest_neighbours(df.limit(0), F.lit(True)).count() == 0
