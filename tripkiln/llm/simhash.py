"""SimHash near-copies by pigeonring filtering.

A fingerprint's 64 bits are cut into ``m`` consecutive segments on a ring.
If two fingerprints differ in at most ``tau`` bits, then from some segment on
every chain of ``l`` consecutive segments differs in at most
``floor(l * tau / m)`` bits. The chain's first segments have budget 0 and the
next few budget 1, so one half of those next segments is equal as well: equal
bits make the key under which candidates meet (two keys a start). Inside a
key the growing chains are checked one length after the other; only pairs
that pass all of them reach the full Hamming check (the chain of length m).

Copies share a fingerprint and are one node. A key gives star links from the
smallest fingerprint of each group it connects, not all pairs, and a key with
very many fingerprints is cut into blocks that meet pairwise, so every task
holds at most two blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripkiln.llm.common import fresh, sorted_groups, small_batches, stage, table
from tripkiln.llm.components import connected_components

SHINGLE_WORDS = 4
MAX_BITS = 4
#: Fingerprints of one key that one block holds.
BLOCK = 4000
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_FULL = (1 << 64) - 1


def text_fingerprint(text: bytes | None, shingle: int = SHINGLE_WORDS) -> int:
    """SimHash of the word shingles (repeats count) by XXH64 with seed 42; a
    shorter text is one shingle; no words (or null) give 0."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    joined, n, digest = b" ".join(words), len(words), xxhash.xxh64_intdigest
    if n <= shingle:
        return digest(joined, 42)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: n - shingle + 1]
    ends = ends[shingle - 1 :]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 16):
        part = slice(at, at + (1 << 16))
        h = np.array([digest(joined[s:e], 42) for s, e in zip(starts[part].tolist(), ends[part].tolist())], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column, shingle: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of a text as a signed long."""

    @F.arrow_udf(T.LongType())
    def simhash(texts: pa.Array) -> pa.Array:
        values = np.fromiter((text_fingerprint(t.as_py(), shingle) for t in texts), np.uint64, len(texts))
        return pa.array(values.view(np.int64))

    return simhash(text.cast("binary"))


class Ring:
    """Segment masks, chain budgets and candidate keys for ``tau`` bits."""

    def __init__(self, tau: int, segments: int | None = None):
        m = segments or 2 * tau + 1
        if not tau < m <= 64:
            raise ValueError("pigeonring needs more segments than allowed bits, 64 at most")
        edges = [64 * i // m for i in range(m + 1)]
        seg = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(m)]
        chain = lambda start, a, b: sum(seg[(start + j) % m] for j in range(a, b))
        self.m, self.budgets = m, [length * tau // m for length in range(m + 1)]
        #: chains[start, l]: bits of the first l segments from start on
        self.chains = np.array([[chain(s, 0, n) for n in range(m + 1)] for s in range(m)], np.uint64)
        zero = max(n for n in range(m + 1) if self.budgets[n] == 0)
        one = max(n for n in range(m + 1) if self.budgets[n] <= 1)
        self.first = zero + 1
        halves = [(zero, (zero + one) // 2), ((zero + one) // 2, one)] if one - zero >= 2 else [(0, 0)]
        #: (start, mask) of every key
        self.keys = [(s, chain(s, 0, zero) | chain(s, *h)) for s in range(m) for h in halves]

    def near(self, x: np.ndarray, start: np.ndarray | int) -> np.ndarray:
        """Which of the differences ``x`` pass every chain from ``start`` on."""
        left = np.arange(len(x))
        for n in range(self.first, self.m + 1):
            s = start[left] if isinstance(start, np.ndarray) else start
            left = left[np.bitwise_count(x[left] & self.chains[s, n]) <= self.budgets[n]]
        return left


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _group_links(fps: np.ndarray, start: int, ring: Ring) -> tuple[np.ndarray, np.ndarray]:
    """Star links of the groups that the near pairs of ``fps`` connect: from
    each one, all fingerprints still outside are compared in one sweep."""
    left = np.sort(fps)
    roots, members = [], []
    while len(left) > 1:
        root, front, left = left[0], [left[0]], left[1:]
        while front and len(left):
            hit = ring.near(left ^ front.pop(), start)
            if len(hit):
                front.extend(left[hit])
                roots.append(np.full(len(hit), root))
                members.append(left[hit])
                left = np.delete(left, hit)
    none = np.empty(0, np.uint64)
    return (np.concatenate(roots), np.concatenate(members)) if roots else (none, none)


def _links_of(ring: Ring):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts_of_key = np.array([s for s, _ in ring.keys])
        for t in sorted_groups(batches, ["k", "v", "unit"]):
            k, v, unit = (t.column(c).to_numpy() for c in ("k", "v", "unit"))
            fp = t.column("fp").to_numpy().view(np.uint64)
            new = np.ones(len(k), bool)
            new[1:] = (k[1:] != k[:-1]) | (v[1:] != v[:-1]) | (unit[1:] != unit[:-1])
            begin = np.flatnonzero(new)
            size = np.diff(np.append(begin, len(k)))
            a, b = [], []
            few = np.repeat((size > 1) & (size <= 16), size)
            group = np.repeat(np.arange(len(size)), size)
            for d in range(1, 16):  # small groups: all at once, by distance in the sorted rows
                i = np.flatnonzero(few[:-d] & (group[d:] == group[:-d])) if d < len(k) else np.empty(0, int)
                if not len(i):
                    break
                i = i[ring.near(fp[i] ^ fp[i + d], starts_of_key[k[i]])]
                a.append(fp[i])
                b.append(fp[i + d])
            for g in np.flatnonzero(size > 16):
                x, y = _group_links(fp[begin[g] : begin[g] + size[g]], int(starts_of_key[k[begin[g]]]), ring)
                a.append(x)
                b.append(y)
            if a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(z).view(np.int64)) for z in (a, b)], names=["a", "b"]
                )

    return links


def hamming_links(nodes: DataFrame, max_bits: int = MAX_BITS, segments: int | None = None, block: int = BLOCK) -> DataFrame:
    """Links ``(a, b)`` between the distinct longs of ``nodes.fp`` that
    connect exactly the groups that all pairs within ``max_bits`` connect."""
    ring = Ring(max_bits, segments)
    keys = nodes.select(
        "fp",
        F.explode(F.array(*[F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("v")) for i, (_, m) in enumerate(ring.keys)])).alias("key"),
    ).select("key.k", "key.v", "fp")
    hot = stage(
        keys.groupBy("k", "v").agg(F.count("*").alias("n")).where(F.col("n") > block)
        .select("k", "v", F.ceil(F.col("n") / block).cast("int").alias("g")),
        "hot-keys",
    )
    if hot.isEmpty():
        units = keys.withColumn("unit", F.lit(0))
    else:
        # g blocks meet pairwise: unit i * g + j holds blocks i < j
        mine = F.pmod(F.xxhash64("fp"), F.col("g")).cast("int")
        others = F.filter(F.sequence(F.lit(0), F.col("g") - 1), lambda j: j != mine)
        units = keys.join(hot, ["k", "v"], "left").select(
            "k", "v", "fp",
            F.explode(
                F.when(F.col("g").isNull(), F.array(F.lit(0))).otherwise(
                    F.transform(others, lambda j: F.least(j, mine) * F.col("g") + F.greatest(j, mine))
                )
            ).alias("unit"),
        )
    return (
        units.repartition("k", "v", "unit").sortWithinPartitions("k", "v", "unit")
        .mapInArrow(_links_of(ring), "a long, b long")
    )


def fingerprint_components(rows: DataFrame, max_bits: int = MAX_BITS, id_col: str = "doc_id") -> DataFrame:
    """``(fp, component, component_id)`` for every fingerprint of ``rows``
    (columns ``id_col`` and ``fp``): the smallest fingerprint and the smallest
    id that links reach; the id is null only where every reachable id is."""
    nodes = stage(rows.groupBy("fp").agg(F.min(id_col).alias("least")), "fingerprints")
    comps = connected_components(hamming_links(nodes.select("fp"), max_bits))
    placed = nodes.join(comps.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    smallest = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    return placed.join(smallest, "component").select("fp", "component", "component_id")


def simhash_groups(
    docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row a document: id, ``fingerprint`` (16 lowercase hex digits) and
    ``component_id``. Null and empty texts have fingerprint 0 and link like
    any other; repeated rows come back repeated; a null id counts for links
    but never names a group unless the whole group has none."""
    small_batches(docs.sparkSession)
    fps = stage(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), shingle).alias("fp")), "simhash")
    groups = fingerprint_components(fps, max_bits, "id")
    return fps.join(groups, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(
    docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One document of each group stays: the one with the smallest id (no id:
    last), then the smallest hash of its text. Rows that repeat both are one
    document and come back once. All columns are kept."""
    small_batches(docs.sparkSession)
    (th,) = fresh(docs.columns + ["id", "fp", "first_th", "component"], "th")
    key = F.xxhash64(F.col(text_col)).alias(th)
    fps = stage(docs.select(F.col(id_col).alias("id"), key, fingerprint(F.col(text_col), shingle).alias("fp")), "simhash")
    groups = fingerprint_components(fps, max_bits, "id")
    order = F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col(th))
    kept = stage(
        fps.join(groups, "fp").groupBy("component").agg(F.min(order).alias("first"))
        .select(F.col("first.id").alias("id"), F.col(f"first.{th}").alias("first_th")),
        "kept",
    )
    repeated = fps.groupBy("id", th).agg(F.count("*").alias("n")).where("n > 1")
    marked = docs.withColumn(th, F.xxhash64(F.col(text_col)))
    out = marked.join(kept, F.col(id_col).eqNullSafe(kept["id"]) & (F.col(th) == kept["first_th"]), "left_semi")
    if not repeated.isEmpty():  # only then can a kept row repeat
        out = out.dropDuplicates([id_col, th])
    return out.select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
