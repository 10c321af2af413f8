import re

import numpy as np
import pytest
import xxhash

from tests.llm.conftest import SF
from tripkiln.llm import simhash

FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text, k=4):
    w = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().translate(FOLD))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + k]), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def brute_components(fps, bits):
    """Smallest index that links reach, of every fingerprint."""
    f = np.array(fps, np.uint64)
    root = list(range(len(f)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f[i + 1 :] ^ f[i]) <= bits):
            a, b = find(i), find(i + 1 + int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(f))]


def test_query_matches_brute_force(spark, docs):
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    fps = [brute_fingerprint(t) for _, t in rows]
    comps = brute_components(fps, 4)
    want = {(i, f"{f:016x}", rows[c][0]) for (i, _), f, c in zip(rows, fps, comps)}
    assert {tuple(r) for r in simhash.query(spark, SF).collect()} == want


@pytest.mark.parametrize("bits, segments, block", [(4, None, 4000), (4, None, 20), (3, 5, 15), (1, None, 4000), (4, 16, 30)])
def test_links_connect_what_all_pairs_connect(spark, bits, segments, block):
    rng = np.random.default_rng(bits)
    base = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    near = [b ^ np.uint64(sum(1 << int(x) for x in rng.choice(64, rng.integers(0, 7), replace=False))) for b in base for _ in range(20)]
    fps = np.unique(np.concatenate([base, np.array(near, np.uint64), np.arange(40, dtype=np.uint64)]))
    nodes = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    links = simhash.hamming_links(nodes, bits, segments, block).collect()
    at = {int(x): i for i, x in enumerate(fps.view(np.int64))}
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in links:
        a, b = find(at[r["a"]]), find(at[r["b"]])
        root[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(fps))] == brute_components(fps, bits)


def test_every_near_pair_shares_a_key():
    rng = np.random.default_rng(0)
    ring = simhash.Ring(4)
    for _ in range(2000):
        x = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        starts = [s for s, mask in ring.keys if not x & mask]
        assert any(len(ring.near(np.array([x], np.uint64), s)) for s in starts)


def test_edge_rows(spark, edge_docs, no_docs):
    got = simhash.simhash_groups(edge_docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"] and got.count() == edge_docs.count()
    zero = {r["component_id"] for r in got.where("fingerprint = '0000000000000000'").collect()}
    assert zero == {2}  # null, empty and blank texts
    assert simhash.simhash_groups(no_docs).count() == 0


def test_one_document_of_each_group_stays(spark, edge_docs, no_docs):
    groups = simhash.simhash_groups(edge_docs)
    kept = simhash.drop_near_copies(edge_docs)
    assert kept.columns == edge_docs.columns
    want = {r["component_id"] for r in groups.collect()}
    assert sorted((r["doc_id"] for r in kept.collect()), key=lambda x: (x is None, x)) == sorted(want, key=lambda x: (x is None, x))
    assert simhash.drop_near_copies(no_docs).count() == 0
    nobody = spark.createDataFrame([(None, "a b c d e")] * 3 + [(None, "other words than these here")], "doc_id long, text string")
    assert simhash.drop_near_copies(nobody).count() == 2
