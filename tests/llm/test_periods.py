"""Runs against a brute force over all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import LONG, SF
from tripkiln.llm import periods


def brute_runs(words, min_length=6, exponent=4):
    """(start, length, smallest period) of every run: for every period all maximal stretches that keep it."""
    _, s = np.unique(np.array(words, object).astype(str), return_inverse=True) if len(words) else (None, np.empty(0))
    out = {}
    for q in range(1, len(s) // exponent + 1):
        same = np.concatenate([[False], s[q:] == s[:-q], [False]])
        begin, end = np.flatnonzero(~same[:-1] & same[1:]), np.flatnonzero(same[:-1] & ~same[1:])
        for a, b in zip(begin.tolist(), end.tolist()):
            if b - a + q >= max(min_length, exponent * q):
                out.setdefault((a, b - a + q), q)
    return sorted(((a, k, q) for (a, k), q in out.items()), key=lambda r: (r[0], r[2]))


def planted(i, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(i).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
    return [w.decode() for w in words]


def brute_row(i, text):
    words = planted(i, text)
    runs = brute_runs(words)
    gone = {k for s, n, p in runs for k in range(s + p, s + n)}
    best = (None,) * 4
    for s, n, p in runs:
        if best[0] is None or n * best[2] > best[1] * p:
            best = (s, n, p, 1000 * n // p)
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    left = " ".join(w for k, w in enumerate(words) if k not in gone)
    return (i, len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())


@pytest.mark.parametrize("exponent", [3, 4, 5])
def test_find_runs(exponent):
    rng = random.Random(exponent)
    for _ in range(500):
        n, k = rng.randint(0, 120), rng.choice([1, 2, 3, 6])
        s = [rng.randrange(k) for _ in range(n)]
        for _ in range(rng.randint(0, 3) if n else 0):  # stretches of some period, over and inside each other
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.randint(2, 10)
            for i in range(a, rng.randint(a, n)):
                s[i] = s[a + (i - a) % p]
        symbols = np.unique(np.array(s, np.int64), return_inverse=True)[1]
        got = [tuple(r) for r in periods.find_runs(symbols, exponent=exponent).tolist()]
        assert got == brute_runs(s, 6, exponent), s


def test_texts_that_deceive_hashes_and_long_runs():
    morse = [bin(i).count("1") % 2 for i in range(1 << 12)]
    for s in (morse, morse * 5, [0] * 20_000, [0, 1] * 3000 + [2] + [0, 1] * 3000):
        got = [tuple(r) for r in periods.find_runs(np.unique(s, return_inverse=True)[1]).tolist()]
        assert got == ([(0, len(s), 1)] if len(set(s)) == 1 else brute_runs(s))


def test_a_hash_that_always_agrees_changes_nothing(monkeypatch):
    def liar(symbols, longest):
        return lambda pos, dist: (pos * 0 + pos, len(symbols) - pos - dist)

    monkeypatch.setattr(periods, "_reach", liar)
    s = [0, 1, 2] * 5 + [3, 4] + [1] * 9 + [5]
    assert [tuple(r) for r in periods.find_runs(np.array(s)).tolist()] == [(0, 15, 3), (17, 9, 1)]


def test_wavelet_tree():
    rng = np.random.default_rng(2)
    for m in (1, 2, 63, 64, 65, 1000):
        a = rng.permutation(m)
        tree = periods.WaveletTree(a)
        lo, hi = np.sort(rng.integers(0, m + 1, (2, 200)), axis=0)
        x = rng.integers(0, m + 1, 200)
        less = tree.less(lo, hi, x)
        assert less.tolist() == [(a[i:j] < v).sum() for i, j, v in zip(lo, hi, x)]
        some = less < hi - lo  # range successor: the smallest value not below x
        assert tree.nth(lo[some], hi[some], less[some]).tolist() == [
            min(v for v in a[i:j] if v >= y) for i, j, y in zip(lo[some], hi[some], x[some])
        ]


def test_query_matches_brute_force(spark, docs):
    want = sorted(brute_row(r["doc_id"], r["text"]) for r in docs.collect())
    got = periods.query(spark, SF)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 6 + ["string"] * 2
    assert sorted(map(tuple, got.collect())) == want
    assert sum(r[1] for r in want) > 5


def test_runs_and_collapsed_texts(spark, monkeypatch):
    rows = [
        (1, "a b a b a b a b c"), (1, "a b a b a b a b c"), (2, "x x x x x"), (3, "x x x x x x\n\ty"), (4, None), (5, ""), (6, " \t\n "),
        (None, "é é é é é é"), (7, "z z " * 8), (8, "a b a b a b a b " + "b b b b b c " * 4),
    ]
    df = spark.createDataFrame(rows, "id long, text string").withColumn("RUNS", F.lit("x")).coalesce(1)
    for words in (periods.BATCH_WORDS, 7):
        got = periods.periodic_runs(df).select("id", "text", "runs", "collapsed").collect()
        assert len(got) == len(rows)
        for r in got:
            words = (r["text"] or "").encode().split()
            assert [tuple(x) for x in r["runs"]] == brute_runs([w.decode() for w in words])
            gone = {k for s, n, p in map(tuple, r["runs"]) for k in range(s + p, s + n)}
            assert r["collapsed"] == b" ".join(w for k, w in enumerate(words) if k not in gone).decode()
        monkeypatch.setattr(periods, "BATCH_WORDS", 7)


def test_edge_rows(spark, edge_docs, no_docs):
    got = periods.periodic_runs(edge_docs)
    assert got.columns == [*edge_docs.columns, "collapsed", "runs"] and got.count() == edge_docs.count()
    long = got.where("length(text) > 1000").collect()
    assert len(long) == 2 and all([tuple(x) for x in r["runs"]] == [(0, 40_000, 977)] for r in long) and len(LONG.split()) == 40_000
    assert got.where("text is null").select("collapsed", F.size("runs")).collect() == [("", 0)]
    assert periods.periodic_runs(no_docs).count() == 0
    planted_rows = periods.plant(edge_docs)
    assert planted_rows.count() == edge_docs.count() and planted_rows.where("doc_id is null").first()["text"] == "one two three four five seven"
