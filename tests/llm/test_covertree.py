import numpy as np
import pytest
from pyspark.sql import functions as F

from tripkiln.llm import covertree as ct


def _brute(rows, threshold=0.93):
    """rows: (id, vector, label) without nulls; links and components."""
    n = [0] * len(rows)
    comp = list(range(len(rows)))
    x = np.array([r[1] for r in rows], np.float32).astype(np.float64)
    norm = np.linalg.norm(x, axis=1)
    cosine = (x @ x.T) / (norm[:, None] * norm[None])

    def find(a):
        while comp[a] != a:
            a = comp[a]
        return a

    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    place = {i: k for k, i in enumerate(order)}
    for i in range(len(rows)):
        for j in range(len(rows)):
            if i != j and rows[i][2] == rows[j][2] and cosine[i, j] >= threshold:
                n[i] += 1
                a, b = find(place[i]), find(place[j])
                comp[max(a, b)] = min(a, b)
    return {(rows[i][0], n[i], rows[order[find(place[i])]][0], rows[order[find(place[i])]][0] == rows[i][0]) for i in range(len(rows))}


def _rows(seed, n, d):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n // 6, d))
    x = np.vstack([base + s * rng.standard_normal(base.shape) for s in (0, 0, 0.2, 0.28, 0.3, 0.5)]) * rng.uniform(0.1, 9, (n // 6 * 6, 1))
    ids = rng.permutation(len(x))
    return [(int(i), [float(f) for f in v.astype(np.float32)], int(i % 3)) for i, v in zip(ids, x)]


@pytest.mark.parametrize("seed, n, d, block", [(0, 300, 4, 3000), (1, 600, 16, 40), (2, 500, 3, 25), (3, 90, 64, 10)])
def test_matches_brute_force(spark, seed, n, d, block):
    rows = _rows(seed, n, d)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    got = ct.near_vectors(df, block=block)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert {tuple(r) for r in got.collect()} == _brute(rows)


def test_table_matches_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    assert {tuple(r) for r in ct.query(spark, "/root/testdata/sf0.01").collect()} == _brute(rows)


def test_tree_is_nested_with_shrinking_radii():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((800, 3))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    todo = [(ct.build(x, 0.05), None)]
    while todo:
        node, level = todo.pop()
        d = ct._distances(x[node.points], x[node.centre][None])[:, 0]
        assert d.max() <= node.radius + 1e-7 and node.centre in node.points
        if node.children:
            assert node.centre in {c.centre for c in node.children}
            assert sorted(np.concatenate([c.points for c in node.children])) == sorted(node.points)
            radius = level / 2 if level else node.radius / 2
            assert all(c.radius <= radius + 1e-7 for c in node.children)
            todo += [(c, radius) for c in node.children]


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, [1.0, 0.0], None),
        (6, None, 1), (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1), (11, [], 1),
        (12, [1.0, 0.0, 0.0], 1), (None, [0.0, 3.0], 1), (13, [0.0, 4.0], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({c: F.lit("x") for c in ("cid", "grp", "n", "v", "component")})
    got = sorted((tuple(r) for r in ct.near_vectors(df).collect()), key=lambda r: (r[0] is None, r))
    lone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11, 12)]
    assert got == [(1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), *lone, (13, 1, 13, True), (None, 1, 13, False)]
    assert ct.near_vectors(df.limit(0)).count() == 0
