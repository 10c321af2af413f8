"""Hard negatives against a brute force over all pairs."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF
from tests.oracle_compare import compare, duck
from tripkiln.llm import hard_negatives as hn


def brute(rows, is_anchor, positives=5, negatives=3, low=(50, 100), high=(95, 100)):
    ok = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(256 * x) for x in v):
            continue
        ok[i] = min(ok.get(i, (label, v)), (label, v))
    ok = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in ok.items()}
    out = set()
    for a, (of, v) in ok.items():
        if not is_anchor(a):
            continue
        scored = sorted((-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(v, w)))), i, label) for i, (label, w) in ok.items() if i != a)
        for p, i, _ in [s for s in scored if s[2] == of][:positives]:
            fit = [(-n, j) for n, j, label in scored if label != of and low[0] * -p <= low[1] * -n and high[1] * -n <= high[0] * -p]
            out |= {(a, i, k + 1, j, -p, n) for k, (n, j) in enumerate(fit[:negatives])}
    return out


def mined(df, is_anchor, **more):
    got = [tuple(r) for r in hn.mine_hard_negatives(df, is_anchor, **more).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_query_equals_its_sql(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    ok, n_spark, n_duck, _, detail = compare(spark, duck(sf_dir), "op12", hn.query, hn.ORACLE, sf_dir)
    assert ok, detail
    assert n_spark == n_duck > 0


def test_query_matches_brute_force(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"], r["embedding"]) for r in table.collect()]
    assert set(map(tuple, hn.query(spark, SF).collect())) == brute(rows, lambda i: i % 50 == 0)


@pytest.mark.parametrize("block_rows", [None, 40])
def test_ties_copies_and_a_label_of_a_third(spark, block_rows):
    rng = random.Random(block_rows or 0)
    values = [0.0, 0.25, 0.5, 1.0, -0.5]
    rows = [(i, 0 if i % 3 == 0 else rng.randrange(12), [rng.choice(values) for _ in range(3)]) for i in range(300)]
    rows += [(300 + i, 1, [0.5, 0.5, 0.5]) for i in range(60)] + [(400 + i, 2, [0.5, 0.5, 0.25]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").repartition(7)
    got = mined(df, F.col("vec_id") % 10 == 0, block_rows=block_rows)
    assert got == brute(rows, lambda i: i % 10 == 0) and len(got) > 200
    got = mined(df, F.col("vec_id") % 10 == 0, block_rows=block_rows, positives=2, negatives=7, low=(1, 3), high=(1, 1))
    assert got == brute(rows, lambda i: i % 10 == 0, 2, 7, (1, 3), (1, 1))


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.5]), (2, 2, [0.5, 0.5]), (3, None, [1.0, 1.0]), (4, 2, None), (5, 2, [nan, 1.0]), (6, 2, [inf, 1.0]),
        (7, 2, [None, 1.0]), (None, 2, [0.5, 0.5]), (8, 2, [0.75]), (9, 1, []), (10, 2, [0.0, 0.0]), (2, 2, [0.5, 0.5]), (2, 3, [0.9, 0.5]),
        (11, 2, [1e308, 0.0]), (50, 7, [0.5, 0.5]), (100, 2, [-0.5, -0.5]), (150, 1, [0.0, 0.0, 3.0]), (-50, 3, [0.3, 0.9]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumns({c: F.lit("x") for c in ("KEY", "block", "tops", "id")})
    got = mined(df, F.col("vec_id") % 50 == 0)
    assert got == brute(rows, lambda i: i % 50 == 0)
    assert {r[0] for r in got} >= {0, 150} and not any(r[0] == 50 for r in got)  # the only one of its label
    zero = spark.createDataFrame([(2, 1, [0.0]), (1, 2, [0.0]), (0, 1, [1.0])], df.select("vec_id", "label", "embedding").schema)
    assert mined(zero, F.col("vec_id") == 0) == {(0, 2, 1, 1, 0, 0)}  # a negative of the same score and a smaller id
    assert mined(df.limit(0), F.lit(True)) == set() and mined(df, F.lit(False)) == set()


def test_large_components_are_exact(spark):
    big = [(0, 1, [2.0**40, 3.0]), (1, 1, [2.0**38, 1.0]), (2, 2, [2.0**37 + 7, 1.0]), (3, 2, [2.0**37 + 7, 1.25]), (4, 2, [2.0**60, 0.0]), (5, 1, [2.0**70, 0.0])]
    df = spark.createDataFrame(big, "vec_id long, label int, embedding array<double>")
    assert mined(df, F.col("vec_id") == 0) == brute(big, lambda i: i == 0)


def test_keys_keep_the_order():
    rng = random.Random(4)
    ends = [-(2**63), -(2**63) + 1, -1, 0, 1, 2**63 - 1]
    rows = [(rng.choice(ends), rng.choice([*ends, rng.randrange(-99, 99)]), rng.random() < 0.5, rng.choice(ends)) for _ in range(500)]
    keys = hn.pack(*(np.array(c) for c in zip(*rows)))
    assert [list(c) for c in hn.unpack(keys.slice(3, 50))] == [list(c) for c in zip(*rows[3:53])]
    by_bytes = sorted(range(500), key=lambda i: keys[i].as_py())
    assert [rows[i] for i in by_bytes] == sorted(rows, key=lambda r: (r[0], -r[1], r[2], r[3]))
    assert [len(c) for c in hn.unpack(pa.array([], pa.binary()))] == [0, 0, 0, 0]


def test_anchors_meet_a_block_in_parts(monkeypatch):
    """Few scores at once give the same keys."""
    rng = np.random.default_rng(1)
    n = 120
    rows = {"block": [0] * n, "asks": [0] * (n - 40) + [1] * 40, "id": list(range(n)), "label": [i % 3 for i in range(n)], "v": rng.random((n, 4)).tolist()}
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.float32())]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows.values(), types)], names=list(rows))

    def keys():
        return sorted(k for b in hn._best_positives(5)(iter([batch.slice(0, 50), batch.slice(50)])) for k in b.column(0).to_pylist())

    whole = keys()
    monkeypatch.setattr(hn, "SCORES_AT_ONCE", 300)
    assert keys() == whole and len(whole) == 40 * 5
