"""Runs: stretches of words that repeat with a period.

A run of period q is long enough to hold a dyadic block (a stretch of
``l`` = 2^k words that begins at a multiple of l) whose next copy lies q
words on. So for every level the blocks ask for their occurrences in the
window of the distances that belong to the level:

* prefix doubling numbers all stretches of 2^k words; it leaves a suffix
  array, in which the copies of a block are an interval;
* a wavelet tree over the suffix array tells the smallest position of such an
  interval that is not before a given one (range successor), and how many lie
  in the window;
* the window is shorter than the block, so its occurrences are an arithmetic
  progression, told by the first two and their number. Its members are the
  candidate periods;
* a candidate is extended to both sides by comparing prefix hashes, and what
  is long enough is compared word by word.

Texts are independent of each other: one Arrow pass, no shuffle. Texts of one
batch share the arrays (words of different texts are different symbols), so
short texts cost no calls of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripkiln.llm.common import ranges, table

MIN_LENGTH = 6
#: Least length in periods (3 or more: below that a window's occurrences are no progression).
MIN_EXPONENT = 4
#: Words whose arrays are held at once; one longer text is taken alone.
BATCH_WORDS = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)


class WaveletTree:
    """Counts and selects values of intervals of an array of 0..m-1
    (wavelet matrix, bits packed by 64)."""

    def __init__(self, values: np.ndarray):
        self.size = len(values)
        self.bits = max(1, int(self.size).bit_length())
        self.levels = []
        a = values.astype(np.uint32 if self.size < 1 << 32 else np.uint64)
        for b in range(self.bits - 1, -1, -1):
            bit = ((a >> b) & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            packed = np.concatenate([packed, np.zeros(8 + -len(packed) % 8, np.uint8)]).view(np.uint64)
            before = np.zeros(len(packed), np.int64)
            np.cumsum(np.bitwise_count(packed[:-1]), out=before[1:])
            self.levels.append((packed, before, self.size - int(bit.sum())))
            a = np.concatenate([a[~bit], a[bit]])

    @staticmethod
    def _ones(packed: np.ndarray, before: np.ndarray, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return before[word] + np.bitwise_count(packed[word] & mask)

    def less(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of [lo, hi) are less than x (x up to m)."""
        count = np.zeros(len(lo), np.int64)
        for b, (packed, before, zeros) in zip(range(self.bits - 1, -1, -1), self.levels):
            lo1, hi1 = self._ones(packed, before, lo), self._ones(packed, before, hi)
            one = (x >> b) & 1 == 1
            count += np.where(one, (hi - hi1) - (lo - lo1), 0)
            lo = np.where(one, zeros + lo1, lo - lo1)
            hi = np.where(one, zeros + hi1, hi - hi1)
        return count

    def nth(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value (from 0) of [lo, hi)."""
        value = np.zeros(len(lo), np.int64)
        for b, (packed, before, zeros) in zip(range(self.bits - 1, -1, -1), self.levels):
            lo1, hi1 = self._ones(packed, before, lo), self._ones(packed, before, hi)
            low = (hi - hi1) - (lo - lo1)
            one = k >= low
            value += one.astype(np.int64) << b
            k = np.where(one, k - low, k)
            lo = np.where(one, zeros + lo1, lo - lo1)
            hi = np.where(one, zeros + hi1, hi - hi1)
        return value


def _groups(changes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted rows at places ``at``, whose groups begin at ``changes``:
    the place of each row's group and its size."""
    first = np.flatnonzero(changes)
    sizes = np.diff(np.append(first, len(at)))
    return np.repeat(at[first], sizes), np.repeat(sizes, sizes)


def _block_queries(symbols: np.ndarray, longest: int, exponent: int):
    """The suffix array (as far as it is needed), its entries that some block
    may ask for, and per level (l, positions of the repeated blocks, begin
    and size of their intervals)."""
    n = len(symbols)
    sa = np.argsort(symbols, kind="stable")
    ordered = symbols[sa]
    start, size = _groups(np.append(True, ordered[1:] != ordered[:-1]), np.arange(n))
    rank = np.empty(n, np.int64)
    rank[sa] = start
    keep = size > 1
    active, start, size = np.flatnonzero(keep), start[keep], size[keep]
    wanted, asks, length = np.empty(0, np.int64), [], 1
    # a block of l words serves periods of (2 l - 1) / (e - 1) words or more, a run of which has e times so many
    while len(active) and exponent * -(-(2 * length - 1) // (exponent - 1)) <= longest:
        pos = sa[active]
        if _distances(length, exponent):
            if not len(wanted):
                wanted = active
            block = pos % length == 0
            asks.append((length, pos[block], start[block], size[block]))
        ahead = pos + length
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
        order = np.lexsort((second, start))
        pos, second = pos[order], second[order]
        new = np.append(True, (start[1:] != start[:-1]) | (second[1:] != second[:-1]))
        sa[active] = pos
        start, size = _groups(new, active)
        rank[pos] = start
        keep = size > 1
        active, start, size = active[keep], start[keep], size[keep]
        length *= 2
    return sa, wanted, asks


def _distances(length: int, exponent: int) -> range:
    """Periods that the blocks of one level find: those of q words for which
    l is the greatest power of two up to ((e - 1) q + 1) / 2, so that any e q
    words hold a whole block and its copy q words on."""
    e = exponent - 1
    return range(-(-(2 * length - 1) // e), -(-(4 * length - 1) // e))


def _candidates(sa: np.ndarray, wanted: np.ndarray, asks: list, exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of blocks and distances of their copies, level by level."""
    if not len(wanted):
        return
    places = np.sort(sa[wanted])
    tree = WaveletTree(np.searchsorted(places, sa[wanted]))
    for length, pos, start, size in asks:
        near = _distances(length, exponent)
        lo = np.searchsorted(wanted, start)
        hi = lo + size
        from_, to = np.searchsorted(places, pos + near[0]), np.searchsorted(places, pos + near[-1] + 1)
        maybe = to > from_
        pos, lo, hi, from_, to = pos[maybe], lo[maybe], hi[maybe], from_[maybe], to[maybe]
        skip = tree.less(lo, hi, from_)
        count = tree.less(lo, hi, to) - skip
        found = count > 0
        pos, lo, hi, skip, count = pos[found], lo[found], hi[found], skip[found], count[found]
        first = places[tree.nth(lo, hi, skip)] - pos
        step = np.zeros(len(pos), np.int64)
        more = count > 1
        step[more] = places[tree.nth(lo[more], hi[more], skip[more] + 1)] - pos[more] - first[more]
        yield np.repeat(pos, count), np.repeat(first, count) + np.repeat(step, count) * ranges(count)


def _reach(symbols: np.ndarray, longest: int):
    """A function from positions and distances to how far both sides agree
    with themselves that distance on: (words to the left, words from there on)."""
    n = len(symbols)
    rng = np.random.default_rng(7)
    values = rng.integers(0, 1 << 63, int(symbols.max()) + 1, np.uint64)[symbols]
    power = np.full(n, _BASE, np.uint64)
    power[0] = 1
    np.multiply.accumulate(power, out=power)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(values * power, dtype=np.uint64)])
    top = 1 << max(0, int(longest).bit_length())

    def equal(i, j, k, turn):
        return (sums[i + k] - sums[i]) * turn == sums[j + k] - sums[j]

    def reach(pos: np.ndarray, dist: np.ndarray):
        left, right = np.zeros(len(pos), np.int64), np.zeros(len(pos), np.int64)
        turn, step = power[dist], top
        while step:
            j = pos + dist + right
            ok = np.flatnonzero(j + step <= n)
            right[ok[equal(j[ok] - dist[ok], j[ok], step, turn[ok])]] += step
            i = pos - left - step
            ok = np.flatnonzero(i >= 0)
            left[ok[equal(i[ok], i[ok] + dist[ok], step, turn[ok])]] += step
            step >>= 1
        return left, right

    return reach


def _exact_reach(symbols: np.ndarray, longest: int):
    """The same by comparing words, for texts that deceive the hashes."""

    def reach(pos: np.ndarray, dist: np.ndarray):
        left, right = [], []
        for p, d in zip(pos.tolist(), dist.tolist()):
            wrong = np.flatnonzero(symbols[p + d :] != symbols[p : len(symbols) - d])
            right.append(int(wrong[0]) if len(wrong) else len(symbols) - d - p)
            wrong = np.flatnonzero(symbols[:p][::-1] != symbols[d : p + d][::-1])
            left.append(int(wrong[0]) if len(wrong) else p)
        return np.array(left, np.int64), np.array(right, np.int64)

    return reach


def find_runs(
    symbols: np.ndarray, longest: int | None = None, min_length: int = MIN_LENGTH, exponent: int = MIN_EXPONENT
) -> np.ndarray:
    """All runs (rows of start, length, smallest period, in this order) of a
    text of symbols 0..m-1, none longer than ``longest``: stretches with that
    period, at least ``min_length`` words and ``exponent`` periods long, that
    no neighbour extends."""
    if exponent < 3:
        raise ValueError("a run has 3 periods or more")
    none = np.empty((0, 3), np.int64)
    longest = len(symbols) if longest is None else longest
    if longest < max(min_length, exponent):
        return none
    queries = _block_queries(symbols, longest, exponent)
    for extend in (_reach, _exact_reach):
        runs, reach = none, None
        for pos, dist in _candidates(*queries, exponent):
            new = ~_inside(runs, pos, dist)
            pos, dist = pos[new], dist[new]
            if not len(pos):
                continue
            reach = reach or extend(symbols, longest)
            left, right = reach(pos, dist)
            length = left + right + dist
            long = length >= np.maximum(min_length, exponent * dist)
            found = np.column_stack([(pos - left)[long], length[long], dist[long]])
            runs = np.unique(np.concatenate([runs, found]), axis=0)
            # multiples of a period span the same stretch: the least is the period
            runs = runs[np.append(True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1))[: len(runs)]]
        if all(np.array_equal(symbols[s : s + k - p], symbols[s + p : s + k]) for s, k, p in runs.tolist()):
            break
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _inside(runs: np.ndarray, pos: np.ndarray, dist: np.ndarray) -> np.ndarray:
    """Whether a block and its copy begin in the last run that begins before
    the block, a multiple of its period apart: they would find that run again
    (they agree up to its end, as their words keep its period)."""
    if not len(runs):
        return np.zeros(len(pos), bool)
    last = np.searchsorted(runs[:, 0], pos, "right") - 1
    start, length, period = runs[np.maximum(last, 0)].T
    return (last >= 0) & (pos + dist + period <= start + length) & (dist % period == 0) & (pos >= start)


def _batch(texts: list[list[bytes]]) -> Iterator[np.ndarray]:
    """The runs of each text."""
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths)
    codes: dict[bytes, int] = {}
    flat = np.fromiter((codes.setdefault(w, len(codes)) for t in texts for w in t), np.int64, int(ends[-1]))
    text = np.repeat(np.arange(len(texts)), lengths)
    _, symbols = np.unique(text * len(codes) + flat, return_inverse=True)
    runs = find_runs(symbols, int(lengths.max(initial=0)))
    of = np.searchsorted(ends, runs[:, 0], "right")
    runs[:, 0] -= (ends - lengths)[of]
    return iter(np.split(runs, np.searchsorted(of, np.arange(1, len(texts)))))


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    if len(runs):
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
    return b" ".join(words)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_TYPE = T.StructType(
    [
        T.StructField("runs", T.ArrayType(T.StructType([T.StructField(x, T.LongType()) for x in ("start", "length", "period")]))),
        T.StructField("collapsed", T.StringType()),
    ]
)


@F.arrow_udf(_TYPE)
def _runs(texts: pa.Array) -> pa.Array:
    held: list[list[bytes]] = []
    counts, rows, left, size = [], [], [], 0

    def work():
        for words, runs in zip(held, _batch(held) if size else [np.empty((0, 3), np.int64)] * len(held)):
            counts.append(len(runs))
            rows.append(runs)
            left.append(_collapsed(words, runs))

    for t in texts:
        words = (t.as_py() or b"").split()
        if held and size + len(words) > BATCH_WORDS:
            work()
            held, size = [], 0
        held.append(words)
        size += len(words)
    work()
    flat = np.concatenate([np.empty((0, 3), np.int64), *rows])
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
    values = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(_RUN))
    return pa.StructArray.from_arrays(
        [pa.ListArray.from_arrays(offsets, values), pa.array(left, pa.binary()).cast(pa.string())], names=["runs", "collapsed"]
    )


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``runs`` (all runs of the text's words: number of the
    first word, length and smallest period in words; by start, then period)
    and ``collapsed`` (the words, joined by one space, without those that a
    run holds after its first period); columns of these two names are
    replaced.

    Words are runs of characters that are not ASCII white space. A null, empty
    or blank text has no runs and an empty ``collapsed``; rows stand for
    themselves, so ids, ties and repeated rows do not matter. Rows of one
    Arrow batch share a worker's memory, about 100 bytes a word at a time for
    ``BATCH_WORDS`` words or one longer text."""
    keep = [c for c in docs.columns if c.lower() not in ("runs", "collapsed")]
    found = _runs(F.col(text).cast("binary"))
    return docs.select(*keep, found.alias("runs")).select(*keep, F.col("runs.collapsed").alias("collapsed"), F.col("runs.runs").alias("runs"))


def strongest(runs: Column) -> Column:
    """The run with most periods, exactly compared; ties to the earlier one."""
    more = lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best)
    return F.aggregate(runs, F.get(runs, F.lit(0)), more)


def plant(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, every tenth text (by a checksum of the id)
    with a periodic end: of its n words those from word a on repeat the p words there."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    a = F.pmod(F.col("g"), F.col("n"))
    p = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))
    at = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    repeated = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.element_at("words", (at(i) + 1).cast("int")))
    out = docs.select("doc_id", "text", h.alias("h")).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    out = out.withColumns({"n": F.size("words").cast("long"), "g": F.floor(F.col("h") / 10)})
    out = out.withColumn("a", F.when(F.col("n") > 0, a)).withColumn("p", p)
    return out.select("doc_id", F.when(F.col("n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def query(spark, sf_dir: str) -> DataFrame:
    """The runs of all documents, some of them made periodic first."""
    out = periodic_runs(plant(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = strongest(F.col("runs"))
    out = out.select("doc_id", "runs", "collapsed", best.alias("best"))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
