import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF
from tripkiln.llm import packing


def _check(pieces, sizes=packing.BIN_SIZES):
    """No overlaps or gaps, the shortest length that fits, bins numbered once."""
    bins = defaultdict(list)
    for r in pieces:
        bins[r["bin_id"]].append((r["bin_offset"], r["n_tokens"], r["bin_size"]))
    for found in bins.values():
        end = 0
        for offset, n, _ in sorted(found):
            assert offset == end
            end += n
        assert {size for _, _, size in found} == {min(s for s in sizes if s >= end)}
    return bins


def test_query_packs_every_document(spark, docs):
    rows = packing.query(spark, SF).collect()
    words = {r["doc_id"]: len((r["text"] or "").encode().split()) for r in docs.collect()}
    got = defaultdict(list)
    for r in rows:
        got[r["doc_id"]].append((r["piece"], r["start"], r["n_tokens"]))
    for i, n in words.items():
        want = [(k, k * 4096, min(4096, n - k * 4096)) for k in range(max(1, -(-n // 4096)))]
        assert sorted(got[i]) == want
    packed = [r for r in rows if r["n_tokens"]]
    bins = _check(packed)
    assert all(r["bin_id"] is None for r in rows if not r["n_tokens"])
    filled = sum(r["n_tokens"] for r in packed) / sum(found[0][2] for found in bins.values())
    assert filled > 0.95


@pytest.mark.parametrize("seed", range(8))
def test_histogram_runs(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 64): rng.randint(1, 40) for _ in range(rng.randint(1, 30))}
    sizes = (16, 32, 64)
    runs, groups = packing.pack_histogram(counts, sizes)
    pieces, placed = [], defaultdict(int)
    for length, first, count, bin_, each, offset, size in packing.run_rows(runs, groups):
        for n in range(count):
            pieces.append({"bin_id": bin_ + n // each, "bin_offset": offset + n % each * length, "n_tokens": length, "bin_size": size})
        placed[length] += count
    assert placed == counts
    bins = _check(pieces, sizes)
    used = sum(n * c for n, c in counts.items())
    assert sum(f[0][2] for f in bins.values()) <= 2 * used + 64


def test_bin_size_follows_the_cost():
    dear_long = lambda s: s * s
    _, groups = packing.pack_histogram({10: 64}, (16, 64), dear_long)
    assert {size for _, _, size in groups} == {16}
    _, groups = packing.pack_histogram({10: 64}, (16, 64), lambda s: 1)
    assert {size for _, _, size in groups} == {64}


def test_edge_rows(spark, edge_docs, no_docs):
    got = packing.pack_documents(edge_docs)
    assert {"piece", "bin_id", "size", "th"} <= set(got.columns) and len(got.columns) == len({c.lower() for c in got.columns})
    rows = got.collect()
    assert sum(r["n_tokens"] for r in rows) == 6 * 3 + 40_000 + 40_001 + 5
    assert sum(r["bin_id"] is None for r in rows) == 3
    _check([r for r in rows if r["n_tokens"]])
    assert packing.pack_documents(no_docs).count() == 0
    same = spark.range(500).select(F.lit(100).alias("size"))
    assert packing.pack(same, "size").select("bin_id", "bin_offset").distinct().count() == 500
