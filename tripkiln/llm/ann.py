"""Nearest neighbours by a forest of hash prefixes.

Every tree hashes a vector to a long string of symbols (which axis of a
random rotation it lies nearest to, and on which side) and keeps the strings
sorted. A query descends to the longest prefix that any string of a tree
shares with its own; from the deepest level on all trees ascend together,
one symbol at a time, until the prefixes passed hold enough candidates,
which are then measured exactly.

The rows are dealt into blocks of bounded size; each block sorts its own
forest in one task, and the query rows, a stated set, stream through every
block. Nothing is kept on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripkiln.llm.common import stage, table

TREES = 48
SYMBOLS = 4
#: Candidates wanted in a block: at least so many, and this share of it.
MIN_CANDIDATES = 1000
SHARE = 0.2
BLOCK_ROWS = 8192
SEED = 5


def usable(vector: Column) -> Column:
    """Not null, not zero, every component present and finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(vector.isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0), F.lit(False))


class Forest:
    """Sorted hash strings of ``trees`` trees over distinct vectors."""

    def __init__(self, x: np.ndarray, trees: int, symbols: int, seed: int):
        rng = np.random.default_rng(seed)
        d = x.shape[1]
        self.bits = max(1, (2 * d - 1).bit_length())
        self.symbols = max(1, min(symbols, 62 // self.bits))
        self.turns = [
            [np.linalg.qr(rng.standard_normal((d, d)))[0].astype(np.float32) for _ in range(self.symbols)] for _ in range(trees)
        ]
        self.n = len(x)
        self.order, self.strings = [], []
        for codes in self.hash(x):
            order = np.argsort(codes, kind="stable")
            self.order.append(order)
            self.strings.append(codes[order])

    def hash(self, x: np.ndarray) -> Iterator[np.ndarray]:
        x = x.astype(np.float32)
        for tree in self.turns:
            code = np.zeros(len(x), np.int64)
            for turn in tree:
                y = x @ turn
                axis = np.abs(y).argmax(axis=1)
                code = (code << self.bits) | (2 * axis + (y[np.arange(len(y)), axis] > 0))
            yield code

    def prefix_ranges(self, q: np.ndarray) -> np.ndarray:
        """[level, tree, query, 2]: where strings share the first ``level``
        symbols of the query's."""
        out = np.zeros((self.symbols + 1, len(self.turns), len(q), 2), np.int64)
        out[0, :, :, 1] = self.n
        for t, code in enumerate(self.hash(q)):
            for level in range(1, self.symbols + 1):
                shift = self.bits * (self.symbols - level)
                prefix = code >> shift
                out[level, t, :, 0] = np.searchsorted(self.strings[t], prefix << shift, "left")
                out[level, t, :, 1] = np.searchsorted(self.strings[t], (prefix + 1) << shift, "left")
        return out

    def candidates(self, spans: np.ndarray, enough: int) -> np.ndarray:
        """Rows under the prefixes of one query (``spans``: [level, tree, 2]),
        ascending until there are ``enough`` of them."""
        seen = np.zeros(self.n, bool)
        for level in range(self.symbols, 0, -1):
            for t, (lo, hi) in enumerate(spans[level]):
                if hi > lo:
                    seen[self.order[t][lo:hi]] = True
            found = np.flatnonzero(seen)
            if len(found) >= enough:
                return found
        return np.arange(self.n)


def _block(ids: np.ndarray, rids: np.ndarray, x: np.ndarray, k: int, trees: int, symbols: int, seed: int):
    """A function from query rows to their nearest rows of one block."""
    order = np.argsort(ids, kind="stable")
    ids, rids, x = ids[order], rids[order], np.ascontiguousarray(x[order])
    raw = x.view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel()
    _, first, same = np.unique(raw, return_index=True, return_inverse=True)
    forest = Forest(x[first], trees, symbols, seed)
    enough = max(MIN_CANDIDATES, int(SHARE * len(first)))
    by_vector = np.argsort(same, kind="stable")  # copies of a vector, smaller ids first
    begin = np.concatenate([[0], np.cumsum(np.bincount(same))])
    exact = x[first].astype(np.float64)

    def nearest(qrids: np.ndarray, q: np.ndarray):
        spans = forest.prefix_ranges(q)
        for i in range(len(q)):
            found = forest.candidates(spans[:, :, i], enough)
            dist = np.sqrt(((exact[found] - q[i].astype(np.float64)) ** 2).sum(axis=1))
            near = np.argpartition(dist, min(k + 1, len(dist) - 1))[: k + 2] if len(dist) > k + 2 else np.arange(len(dist))
            near = np.flatnonzero(dist <= dist[near].max())
            # of copies only the k + 1 smallest ids can be among the k nearest
            rows = [by_vector[begin[v] : min(begin[v + 1], begin[v] + k + 1)] for v in found[near]]
            d = np.repeat(dist[near], [len(r) for r in rows])
            rows = np.concatenate(rows)
            other = rids[rows] != qrids[i]
            rows, d = rows[other], d[other]
            best = np.lexsort((ids[rows], d))[:k]
            yield ids[rows[best]], d[best]

    return nearest


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _searcher(k: int, trees: int, symbols: int, seed: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, nearest = None, [], None
        for batch in batches:
            keys = np.column_stack([batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy()])
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(keys)]):
                if a == b:
                    continue
                part, here = batch.slice(a, b - a), tuple(keys[a][:2])
                if here != key:
                    key, held, nearest = here, [], None
                if not keys[a][2]:
                    held.append((part.column(3).to_numpy(zero_copy_only=False), part.column(4).to_numpy(), _vectors(part.column(5))))
                    continue
                if nearest is None:
                    if not held:
                        continue
                    nearest = _block(*(np.concatenate(z) for z in zip(*held)), k, trees, symbols, seed)
                    held = []
                qid, qrid, q = part.column(3), part.column(4).to_numpy(), _vectors(part.column(5))
                found = list(nearest(qrid, q))
                n = np.array([len(i) for i, _ in found])
                if n.sum():
                    yield pa.RecordBatch.from_arrays(
                        [
                            qid.take(pa.array(np.repeat(np.arange(len(n)), n))), pa.array(np.repeat(qrid, n)),
                            pa.array(np.concatenate([i for i, _ in found])), pa.array(np.concatenate([d for _, d in found])),
                        ],
                        names=["query_id", "qrid", "vec_id", "score"],
                    )

    return search


def nearest_neighbours(
    vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    trees: int = TREES, symbols: int = SYMBOLS, block_rows: int = BLOCK_ROWS, seed: int = SEED,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row that ``is_query`` its
    ``k`` nearest other rows by Euclidean distance, nearest first, ties to the
    smaller id.

    Rows whose vector is unusable (null, zero, with null or non-finite
    components) or whose id is null take no part; vectors only meet vectors
    of their own length. A repeated row is a candidate like any other: only
    the query's own row is left out. No usable rows, no result."""
    rows = vectors.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull())
    rows = stage(
        rows.select(
            F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("rid"), F.col(vector_col).alias("v"),
            F.size(vector_col).alias("dim"), is_query.alias("query"),
        ),
        "vectors",
    )
    # one row a vector length
    dims = rows.groupBy("dim").agg(F.count("*").alias("n")).collect()
    blocks = F.lit(1)
    for r in dims:
        blocks = F.when(F.col("dim") == r["dim"], F.lit(-(-r["n"] // block_rows))).otherwise(blocks)
    mine = F.pmod(F.xxhash64("rid"), blocks).cast("int")
    index = rows.select("dim", mine.alias("block"), F.lit(0).alias("asks"), "id", "rid", "v")
    asks = rows.where("query").select(
        "dim", F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1)).alias("block"), F.lit(1).alias("asks"), "id", "rid", "v"
    )
    found = (
        index.unionByName(asks).repartition("dim", "block").sortWithinPartitions("dim", "block", "asks")
        .mapInArrow(_searcher(k, trees, symbols, seed), "query_id long, qrid long, vec_id long, score double")
    )
    best = Window.partitionBy("qrid").orderBy("score", "vec_id")  # k rows a block
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def query(spark, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
