"""Hard negatives: rows of other labels that score nearly as high as a positive.

Every pair of an anchor and a row has a score. The pairs are shuffled by the
anchor and sorted within the partitions by a packed key (anchor, descending
score, positives before negatives, id); one iterator runs through the sorted
keys. A positive opens a window of scores below its own, the negatives that
follow fill the open windows. The iterator holds an anchor's few windows, never
its pairs.

A row can only matter if it is among an anchor's first positives or fills one
of its windows, so before the shuffle every block of rows keeps, for every
anchor, only the first few of both (the greatest scores of a block hold the
greatest of all). Blocks of rows are bounded, and the anchors, a stated query
set, stream through all of them: first for the positives, then, with the
windows that these open, for the negatives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripkiln.llm.common import stage, table

#: Rows of a block at most (the anchors are shuffled once a block), and of more blocks than cores.
BLOCK_ROWS, SMALL_BLOCK_ROWS = 65_536, 8192
#: Scores held at once: some anchors against a whole block.
SCORES_AT_ONCE = 1 << 21
SCALE = 256.0
LONG = (1 << 63) - 1
_SIGN = np.uint64(1 << 63)


def whole(vector: Column) -> Column:
    """Not null, and every component present, finite and finite once scaled."""
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double") * SCALE) == float("inf"))
    return F.coalesce(vector.isNotNull() & ~F.exists(vector, bad), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors as rows of whole numbers; shorter ones end in zeros."""
    flat = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    sizes = np.diff(column.offsets.to_numpy())
    width = int(sizes.max(initial=0))
    out = np.zeros((len(column), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products, exact: in doubles where they hold all sums, else in
    Python's integers, at the ends of the range of a long if beyond."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    most = max(1.0, np.abs(a).max(initial=0)) * max(1.0, np.abs(b).max(initial=0)) * max(1, width)
    if most < 1 << 53:
        return a @ b.T
    exact = [[int(v) for v in row] for row in a], [[int(v) for v in row] for row in b]
    rows = [[min(LONG, max(-LONG - 1, sum(map(int.__mul__, x, y)))) for y in exact[1]] for x in exact[0]]
    return np.array(rows, object).reshape(len(a), len(b))


def _first(scores: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per row the places of the ``n`` greatest scores, ties to the earlier;
    places of minus infinity are left out. ``scores`` is spent."""
    every = np.arange(len(scores))
    for _ in range(min(n, scores.shape[1])):
        at = scores.argmax(axis=1)
        ok = np.flatnonzero(scores[every, at] != -np.inf)
        if not len(ok):
            return
        yield ok, at[ok]
        scores[ok, at[ok]] = -np.inf


def _big_endian(x: np.ndarray) -> np.ndarray:
    return (x.astype(np.int64).view(np.uint64) ^ _SIGN).astype(">u8").view(np.uint8).reshape(-1, 8)


def pack(anchor: np.ndarray, score: np.ndarray, negative: np.ndarray, ids: np.ndarray) -> pa.Array:
    """Keys whose byte order is: anchor, score descending, positives first, id."""
    key = np.empty((len(anchor), 25), np.uint8)
    key[:, :8] = _big_endian(anchor)
    key[:, 8:16] = ~_big_endian(score)
    key[:, 16] = negative
    key[:, 17:] = _big_endian(ids)
    offsets = np.arange(len(key) + 1, dtype=np.int32) * 25
    return pa.Array.from_buffers(pa.binary(), len(key), [None, pa.py_buffer(offsets), pa.py_buffer(key.tobytes())])


def unpack(keys: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    if not len(keys):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)
    begin = keys.offset
    offsets = np.frombuffer(keys.buffers()[1], np.int32)[begin : begin + len(keys) + 1]
    key = np.frombuffer(keys.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].reshape(-1, 25)

    def number(part):
        return (np.ascontiguousarray(part).view(">u8").ravel().astype(np.uint64) ^ _SIGN).view(np.int64)

    return number(key[:, :8]), number(~key[:, 8:16]), key[:, 16] == 1, number(key[:, 17:])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, tuple]]:
    """Batches of anchors (sorted behind the rows of their block) with the
    block's ids, labels and vectors, by id."""
    key, held, rows = None, [], None
    for batch in batches:
        keys = np.column_stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
        cuts = (np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, len(keys)]):
            if a == b:
                continue
            part, (block, asks) = batch.slice(a, b - a), keys[a].tolist()
            if block != key:
                key, held, rows = block, [], None
            if not asks:
                held.append(part)
                continue
            if rows is None:
                t = pa.Table.from_batches(held, part.schema).combine_chunks().sort_by("id")
                rows = (t["id"].to_numpy(), t["label"].to_numpy(), _matrix(t["v"].combine_chunks())) if held else ()
                held = []
            if not rows:
                continue
            some = max(1, SCORES_AT_ONCE // len(rows[0]))
            for at in range(0, part.num_rows, some):
                yield part.slice(at, some), rows


def _batch(anchor, score, negative, ids) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pack(anchor, score, negative, ids)], names=["key"])


def _best_positives(n: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for asks, (ids, labels, x) in _blocks(batches):
            anchor, of = asks.column("id").to_numpy(), asks.column("label").to_numpy()
            vectors = _matrix(asks.column("v"))
            for label in np.unique(of):
                mine, same = np.flatnonzero(of == label), np.flatnonzero(labels == label)
                if not len(same):
                    continue
                scores = _scores(vectors[mine], x[same])
                kept = scores.copy()
                kept[anchor[mine][:, None] == ids[same]] = -np.inf
                for row, at in _first(kept, n):
                    yield _batch(anchor[mine[row]], scores[row, at], np.zeros(len(row)), ids[same[at]])

    return search


def _best_negatives(n: int, low: tuple[int, int], high: tuple[int, int]):
    """Of every block what may fill an anchor's windows: the first ``n`` of
    each. A row that is among them for two windows comes once."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for asks, (ids, labels, x) in _blocks(batches):
            anchor, of = asks.column("id").to_numpy(), asks.column("label").to_numpy()
            scores = _scores(_matrix(asks.column("v")), x)
            scores[of[:, None] == labels] = -np.inf
            tops = asks.column("tops").to_pylist()
            picked = np.zeros(scores.shape, bool)
            for k in range(max(len(t) for t in tops)):
                rows = np.array([i for i, t in enumerate(tops) if len(t) > k])
                floor = np.array([-(-low[0] * tops[i][k] // low[1]) for i in rows], scores.dtype)[:, None]
                roof = np.array([high[0] * tops[i][k] // high[1] for i in rows], scores.dtype)[:, None]
                part = scores[rows]
                for row, at in _first(np.where((part >= floor) & (part <= roof), part, -np.inf), n):
                    picked[rows[row], at] = True
            row, at = np.nonzero(picked)
            if len(row):
                yield _batch(anchor[row], scores[row, at], np.ones(len(row)), ids[at])

    return search


def _windows(positives: int, negatives: int, low: tuple[int, int], high: tuple[int, int]):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, opened, windows = None, 0, []
        for batch in batches:
            out = []
            for a, score, negative, i in zip(*(c.tolist() for c in unpack(batch.column(0)))):
                if a != anchor:
                    anchor, opened, windows = a, 0, []
                if not negative:
                    if opened < positives:
                        opened += 1
                        windows.append([i, score, 0])
                    continue
                for w in windows:
                    # all in one scale, as whole numbers
                    if low[0] * w[1] <= low[1] * score and high[1] * score <= high[0] * w[1]:
                        w[2] += 1
                        out.append((a, w[0], w[2], i, w[1], score))
                windows = [w for w in windows if w[2] < negatives]
            cols = list(zip(*out)) or [[]] * 6
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[c.split()[0] for c in _RESULT.split(", ")])

    return emit


_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine_hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3,
    low: tuple[int, int] = (50, 100), high: tuple[int, int] = (95, 100),
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", block_rows: int | None = None,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``: for every row that ``is_anchor`` and each of its first
    ``positives`` other rows of its label, the first ``negatives`` rows of
    other labels whose score is between the fractions ``low`` and ``high`` of
    the positive's (both included).

    A score is the inner product of the vectors' components, each times 256
    and rounded down; greater scores come first, ties by smaller id. Rows
    without id or label, and rows whose vector is null or holds a null or
    non-finite component (also: one that 256 times would not be finite), take
    no part. Rows that share an id count as one: the least by label, then by
    vector. Missing components of the shorter vector count as zero, an empty
    vector scores 0. Scores beyond the range of a long are held at its ends.
    Ids and labels are whole numbers. No anchors, no rows; an anchor without positives has none."""
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).alias("v"), is_anchor.alias("ask"),
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & whole(F.col("v")))
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "v", "ask")).alias("row")).select("id", "row.*")
    rows = stage(rows, "vectors")
    n = rows.count()
    if block_rows is None:
        block_rows = max(SMALL_BLOCK_ROWS, min(BLOCK_ROWS, -(-n // vectors.sparkSession.sparkContext.defaultParallelism)))
    blocks = max(1, -(-n // block_rows))
    index = rows.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("asks"), "id", "label", "v")
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    asks = rows.where("ask").select(every_block, F.lit(1).alias("asks"), "id", "label", "v")

    def by_block(df: DataFrame, search) -> DataFrame:
        return df.repartition("block").sortWithinPartitions("block", "asks").mapInArrow(search, "key binary")

    # the positives of all blocks: a few a block and anchor
    anchor = F.substring("key", 1, 8)
    first = Window.partitionBy(anchor).orderBy("key")
    found = by_block(index.unionByName(asks), _best_positives(positives))
    found = found.withColumn("n", F.row_number().over(first)).where(F.col("n") <= positives).select("key")
    found = stage(found, "positives")
    tops = found.mapInArrow(_tops, "id long, score long").groupBy("id").agg(F.collect_list("score").alias("tops"))
    asks = rows.where("ask").join(tops, "id").select(every_block, F.lit(1).alias("asks"), "id", "label", "v", "tops")
    found = found.unionByName(by_block(index.withColumn("tops", F.lit(None).cast("array<long>")).unionByName(asks), _best_negatives(negatives, low, high)))
    # the secondary sort: partitions by anchor, keys in order within them
    return found.repartition(anchor).sortWithinPartitions("key").mapInArrow(_windows(positives, negatives, low, high), _RESULT)


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        anchor, score, _, _ = unpack(batch.column(0))
        yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(score)], names=["id", "score"])


def moved_labels(vectors: DataFrame) -> DataFrame:
    """Every seventh row with the label after its own."""
    label = F.col("label").cast("long")
    return vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))


def query(spark, sf_dir: str) -> DataFrame:
    return mine_hard_negatives(moved_labels(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 50 == 0)


ORACLE = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (cast(label as bigint) + 1) % 10 else label end as label,
    [floor(256 * cast(x as double)) for x in embedding] as e
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), pairs as (
  select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same,
    cast(list_inner_product(a.e, b.e) as bigint) as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0
), positives as (
  select * from pairs where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
), ranked as (
  select p.anchor_id, p.id as positive_id,
    row_number() over (partition by p.anchor_id, p.id order by n.score desc, n.id) as rank,
    n.id as negative_id, p.score as positive_score, n.score as negative_score
  from positives p join pairs n on n.anchor_id = p.anchor_id and not n.same
    and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score
)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score
from ranked where rank <= 3
"""
