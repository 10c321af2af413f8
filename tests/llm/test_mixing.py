import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF
from tripkiln.llm import mixing


def _targets(sizes):
    """Water filling the slow way: by ever smaller steps of a common level."""
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    total, lo, hi = 1.5 * sum(sizes), 0.0, 1e12
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(mid * w, 2 * s) for w, s in zip(weights, sizes)) < total else (lo, mid)
    return [min(lo * w, 2 * s) for w, s in zip(weights, sizes)]


def test_query_law(spark, docs):
    got = mixing.query(spark, SF).collect()
    again = mixing.query(spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    source = {r["doc_id"]: (r["source"], len((r["text"] or "").encode().split())) for r in docs.collect()}
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for s, n in source.values():
        sizes[s] += n
    for r in got:
        s, n = source[r["doc_id"]]
        assert r["size"] == n and r["source_size"] == sizes[s] and r["taken"] in (0, n, 2 * n)
        taken[s] += r["taken"]
        target[s] = r["target"]
    names = sorted(sizes)
    for s, want in zip(names, _targets([sizes[s] for s in names])):
        assert target[s] == pytest.approx(want, rel=1e-9)
        assert abs(taken[s] - want) <= max(0.01 * want, 60)


def test_fill_comes_near():
    rng = np.random.default_rng(0)
    for n in (1, 5, 40, 900):
        sizes = rng.integers(0, 300, n)
        for need in (0, 1, int(sizes.sum() // 2), int(sizes.sum())):
            got = int(sizes[mixing.fill_to(sizes, need)].sum())
            assert abs(got - need) <= (1 if n >= 40 and need > 1 else sizes.max())


def test_water_fill():
    assert mixing.water_fill([3, 1, 2], [100, 100, 100], 450, 2) == [200, pytest.approx(250 / 3), pytest.approx(500 / 3)]
    assert mixing.water_fill([], [], 0, 2) == []
    assert mixing.water_fill([1, 1], [0, 0], 0, 2) == [0, 0]


@pytest.mark.parametrize("seed", range(6))
def test_flow_is_feasible_largest_and_cheapest(seed):
    rng = random.Random(seed)
    sources = range(4)
    patterns = {tuple(sorted(rng.sample(sources, rng.randint(1, 3)))): rng.randint(1, 6) for _ in range(4)}
    quotas = {s: rng.randint(0, 8) for s in sources}
    flow = mixing.min_cost_flow(patterns, quotas, 2)
    got = {p: sum(f.values()) for p, f in flow.items()}
    for p, f in flow.items():
        assert got[p] <= 2 * patterns[p] and set(f) <= set(p) and min(f.values(), default=0) >= 0
    into = {s: sum(f.get(s, 0) for f in flow.values()) for s in sources}
    assert all(into[s] <= quotas[s] for s in sources)

    def most(capacity):  # largest flow, by the cut over all sets of sources
        best = 10**9
        for mask in range(16):
            cut = {s for s in sources if mask >> s & 1}
            best = min(best, sum(quotas[s] for s in cut) + sum(c for p, c in capacity.items() if set(p) - cut))
        return best

    assert sum(into.values()) == most({p: 2 * c for p, c in patterns.items()})
    first_uses = sum(min(got[p], patterns[p]) for p in patterns)
    assert first_uses == most(patterns)


def test_overlapping_sources(spark):
    rows = spark.range(3000).select("id", (F.col("id") % 7 + 1).alias("size"), F.when(F.col("id") % 3 == 0, F.array(F.lit(0))).when(F.col("id") % 3 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1))).alias("m"))
    total = rows.agg(F.sum("size")).first()[0]
    got = mixing.mix(rows, "size", "m", {0: total * 0.2, 1: total * 0.6}, ["id"])
    by = {tuple(r["m"]): r["t"] for r in got.groupBy("m").agg(F.sum(F.col("size") * F.col("copies")).alias("t")).collect()}
    assert sum(by.values()) == pytest.approx(total * 0.8, rel=0.01)
    assert got.agg(F.max("copies")).first()[0] == 1  # there are enough first uses
    assert by[(1,)] <= total * 0.6 + 10 and by[(0,)] <= total * 0.2 + 10


def test_edge_rows(spark, edge_docs, no_docs):
    got = mixing.mix_by_source(edge_docs)
    assert got.count() == edge_docs.count()
    assert not got.where((F.col("size") == 0) & (F.col("copies") > 0)).count()
    assert mixing.take(edge_docs).columns == edge_docs.columns
    assert mixing.take(edge_docs).count() == got.agg(F.sum("copies")).first()[0]
    assert mixing.mix_by_source(no_docs).count() == mixing.take(no_docs).count() == 0
