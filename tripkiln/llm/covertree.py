"""Exact cosine links between embeddings of one label by cover trees.

Unit vectors link when their distance is at most ``sqrt(2 - 2 t)``. A cover
tree holds nested nets: the nodes of a level are further apart than the
level's radius and cover their points within it, and the radius halves from
level to level. Two trees are traversed together; a pair of nodes whose
centres are further apart than the link distance plus both covering radii
holds no link and is dropped with everything below. What reaches the leaves
is decided by the exact cosine.

Across tasks the tree's upper part is a set of pivots a label (a net of a
bounded sample): every vector belongs to its nearest pivot's cell, and cells
(and single vectors against cells) are pruned by the same bound with covering
radii over all vectors. Cells are cut into blocks of bounded size; a task
traverses one pair of blocks. Copies of a vector are one point with a count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkiln.llm.ann import usable
from tripkiln.llm.common import sorted_groups, stage, table
from tripkiln.llm.components import connected_components

THRESHOLD = 0.93
#: Distinct vectors sampled for the upper nets, and pivots a label at most.
PIVOT_SAMPLE = 2048
PIVOTS = 32
#: Points of one block.
BLOCK = 3000
LEAF = 24
_SLACK = 1e-9


class Node:
    __slots__ = ("centre", "children", "points", "radius")

    def __init__(self, centre: int, radius: float, points: np.ndarray):
        self.centre, self.radius, self.points, self.children = centre, radius, points, []


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (x @ y.T)))


def _net(x: np.ndarray, points: np.ndarray, first: int, radius: float) -> list[tuple[int, np.ndarray]]:
    """Centres further than ``radius`` apart, ``first`` among them, with the
    points nearest to each."""
    nearest, owner, centres = np.full(len(points), np.inf), np.zeros(len(points), int), []
    at = first
    while True:
        d = _distances(x[points], x[at][None])[:, 0]
        closer = d < nearest
        nearest[closer], owner[closer] = d[closer], len(centres)
        nearest[points == at], owner[points == at] = 0.0, len(centres)
        centres.append(at)
        far = np.flatnonzero(nearest > radius)
        if not len(far):
            return [(c, points[owner == i]) for i, c in enumerate(centres)]
        at = points[far[0]]


def build(x: np.ndarray, least: float) -> Node | None:
    """Cover tree of unit vectors; radii halve down to ``least``."""
    if not len(x):
        return None
    everything = np.arange(len(x))
    root = Node(0, float(_distances(x, x[:1]).max(initial=0.0)), everything)
    todo = [(root, root.radius / 2)]
    while todo:
        node, radius = todo.pop()
        if len(node.points) <= LEAF or node.radius <= least or radius < least / 2:
            continue
        for centre, points in _net(x, node.points, node.centre, radius):
            cover = float(_distances(x[points], x[centre][None]).max())
            child = Node(centre, cover, points)
            node.children.append(child)
            todo.append((child, radius / 2))
    return root


def _pairs_within(x: np.ndarray, y: np.ndarray, a: Node, b: Node, reach: float) -> Iterator[tuple[Node, Node]]:
    """Leaf pairs that no bound excludes (for one tree with itself: each once)."""
    todo = [(a, b)]
    while todo:
        p, q = todo.pop()
        ps = p.children or [p]
        qs = q.children or [q]
        if not p.children and not q.children:
            if p is not q or len(p.points) > 1:
                yield p, q
            continue
        d = _distances(x[[n.centre for n in ps]], y[[n.centre for n in qs]])
        bound = reach + _SLACK + np.array([n.radius for n in ps])[:, None] + np.array([n.radius for n in qs])[None]
        for i, j in zip(*np.nonzero(d <= bound)):
            if p is not q or i <= j:
                todo.append((ps[i], qs[j]))


def links(x: np.ndarray, y: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with cosine >= ``threshold`` between the rows of ``x`` and
    ``y`` (None: within ``x``, each pair once, no row with itself)."""
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    ux, nx = unit(x), np.linalg.norm(x, axis=1)
    uy, ny = (ux, nx) if y is None else (unit(y), np.linalg.norm(y, axis=1))
    other = x if y is None else y
    left = build(ux, reach / 2)
    right = left if y is None else build(uy, reach / 2)
    rows, cols = [np.empty(0, int)], [np.empty(0, int)]
    if left is None or right is None:
        return rows[0], cols[0]
    for p, q in _pairs_within(ux, uy, left, right, reach):
        cosine = (x[p.points] @ other[q.points].T) / (nx[p.points][:, None] * ny[q.points][None])
        i, j = np.nonzero(cosine >= threshold)
        if p is q:
            i, j = i[i < j], j[i < j]
        rows.append(p.points[i])
        cols.append(q.points[j])
    return np.concatenate(rows), np.concatenate(cols)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of ``n`` points."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        root = root[root]
        if (root == before).all():
            return root


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return arr.flatten().to_numpy(zero_copy_only=False).reshape(len(arr), -1).astype(np.float64)


def _linker(threshold: float):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, ["grp", "pair", "i", "j"], 4000):
            keys = np.column_stack([t.column(c).to_numpy() for c in ("grp", "pair", "i", "j")])
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(keys)]):
                part = t.slice(a, b - a)
                if b - a < 2:
                    continue
                side, cid, n = (part.column(c).to_numpy() for c in ("side", "cid", "n"))
                x = _matrix(part.column("v"))
                if side.min() == side.max():
                    i, j = links(x, None, threshold) if part.column("own")[0].as_py() else (np.empty(0, int),) * 2
                else:
                    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
                    i, j = links(x[left], x[right], threshold)
                    i, j = left[i], right[j]
                if not len(i):
                    continue
                linked = np.bincount(i, n[j], len(cid)) + np.bincount(j, n[i], len(cid))
                root = cid[_roots(len(cid), i, j)]
                some = np.flatnonzero(linked)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cid[some]), pa.array(linked[some].astype(np.int64)), pa.array(root[some])],
                    names=["cid", "linked", "root"],
                )

    return link


class Pivots:
    """Upper nets of every group: unit centres, and which cell pairs may link."""

    def __init__(self, sample: dict[int, np.ndarray], reach: float, most: int = PIVOTS):
        self.reach, self.centres, self.radius, self.blocks = reach, {}, {}, {}
        for grp, x in sample.items():
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            radius, chosen = 2.0, [0]
            while radius > reach / 2:  # the finest net that has few enough nodes
                net = [c for c, _ in _net(x, np.arange(len(x)), 0, radius)]
                if len(net) > most:
                    break
                chosen, radius = net, radius / 2
            self.centres[grp] = x[chosen]

    def cells(self, grp: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell and distance to its pivot; groups without pivots are one cell."""
        if grp not in self.centres:
            return np.zeros(len(x), int), np.full(len(x), 2.0)
        d = _distances(x, self.centres[grp])
        cell = d.argmin(axis=1)
        return cell, d[np.arange(len(x)), cell]

    def partners(self, grp: int, cell: int, x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Other cells of the group, and which of ``x`` (unit vectors of
        ``cell``) can have links there."""
        if grp in self.centres:
            c, r = self.centres[grp], self.radius[grp]
            d = _distances(x, c)
            near = _distances(c[cell][None], c)[0] <= self.reach + _SLACK + r[cell] + r
            for q in np.flatnonzero(near):
                if q != cell:
                    yield int(q), d[:, q] <= self.reach + _SLACK + r[q]


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _place(pivots: Pivots):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grp, lengths = batch.column(1).to_numpy(), pc.list_value_length(batch.column(3)).to_numpy()
            for g, n in {*zip(grp.tolist(), lengths.tolist())}:
                part = batch.take(pa.array(np.flatnonzero((grp == g) & (lengths == n))))
                cell, d = pivots.cells(g, _unit(_matrix(part.column(3))))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell.astype(np.int32)), pa.array(d)], names=["cid", "grp", "n", "v", "cell", "d"])

    return place


def _deal(pivots: Pivots):
    """Each point to the block pairs it takes part in. Blocks i of cell p and
    j of cell q > p meet in unit (pair, i, j); within a cell i <= j."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grp, cell = batch.column(1).to_numpy(), batch.column(4).to_numpy()
            blk, own = batch.column(5).to_numpy(), batch.column(6).to_numpy()
            take, pair, bi, bj, side, same = [], [], [], [], [], []

            def add(rows, p, q, i, j, s):
                take.append(rows)
                pair.append(np.full(len(rows), p * 4 * PIVOTS + q))
                same.append(np.full(len(rows), p == q))
                bi.append(np.broadcast_to(i, len(rows)))
                bj.append(np.broadcast_to(j, len(rows)))
                side.append(np.broadcast_to(s, len(rows)))

            for g, p in {*zip(grp.tolist(), cell.tolist())}:
                rows = np.flatnonzero((grp == g) & (cell == p))
                b = blk[rows]
                for j in range(int(own[rows[0]])):
                    add(rows, p, p, np.minimum(b, j), np.maximum(b, j), (b > j).astype(int))
                unit = _unit(_matrix(batch.column(3).take(pa.array(rows))))
                for q, inside in pivots.partners(g, p, unit):
                    some, sb = rows[inside], b[inside]
                    for j in range(int(pivots.blocks[g][q])):
                        if p < q:
                            add(some, p, q, sb, j, 0)
                        else:
                            add(some, q, p, j, sb, 1)
            t = pa.array(np.concatenate(take)) if take else pa.array([], pa.int64())
            cat = lambda z: pa.array(np.concatenate(z).astype(np.int32)) if z else pa.array([], pa.int32())
            i, j, s = cat(bi), cat(bj), cat(side)
            own = pc.and_(pc.equal(i, j), pc.equal(cat(same), 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(t), cat(pair), i, j, s, own, batch.column(0).take(t), batch.column(2).take(t), batch.column(3).take(t)],
                names=["grp", "pair", "i", "j", "side", "own", "cid", "n", "v"],
            )

    return deal


def cosine_links(points: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """``(cid, linked, root)`` from ``points(cid, grp, n, v)``, distinct
    vectors that occur ``n`` times: parts of how many other vectors each point
    links to, and links to a ``root`` that connect what linked pairs connect."""
    points = points.select("cid", "grp", "n", "v")
    sample = points.orderBy(F.xxhash64("cid"), "cid").limit(PIVOT_SAMPLE).select("grp", "v").collect()  # bounded
    by_group: dict[int, list] = {}
    for r in sample:
        by_group.setdefault(r["grp"], []).append(r["v"])
    pivots = Pivots({g: np.array(v, np.float64) for g, v in by_group.items()}, float(np.sqrt(max(0.0, 2 - 2 * threshold))))
    placed = stage(points.mapInArrow(_place(pivots), "cid long, grp long, n long, v array<float>, cell int, d double"), "cells")
    cells = stage(
        placed.groupBy("grp", "cell").agg(F.max("d").alias("radius"), F.ceil(F.count("*") / block).cast("int").alias("blocks")), "cell-sizes"
    )
    # groups with pivots only: at most PIVOT_SAMPLE rows
    known = cells.where(F.col("grp").isin(list(by_group))).collect() if by_group else []
    for g, c in pivots.centres.items():
        pivots.radius[g], pivots.blocks[g] = np.full(len(c), -10.0), np.zeros(len(c), int)  # empty cells link to nothing
    for r in known:
        pivots.radius[r["grp"]][r["cell"]], pivots.blocks[r["grp"]][r["cell"]] = r["radius"], r["blocks"]
    sized = placed.join(cells.select("grp", "cell", "blocks"), ["grp", "cell"]).select(
        "cid", "grp", "n", "v", "cell", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int").alias("blk"), F.col("blocks").alias("own")
    )
    units = sized.mapInArrow(
        _deal(pivots), "grp long, pair int, i int, j int, side int, own boolean, cid long, n long, v array<float>"
    )
    key = ["grp", "pair", "i", "j"]
    return units.repartition(*key).sortWithinPartitions(*key).mapInArrow(_linker(threshold), "cid long, linked long, root long")


def near_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str = "label", block: int = BLOCK,
) -> DataFrame:
    """One row a vector: id, ``n_links`` (other rows with cosine >=
    ``threshold`` and the same label), ``component_id`` (the smallest id that
    links reach, itself included) and ``kept`` (it names its component).

    Unusable vectors (null, zero, null or non-finite components) and null
    labels link with nothing, nor do vectors of different lengths. Repeated
    rows are vectors like any other. A null id never names a component that
    has another id."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<float>").alias("v"))
    valid = rows.where(usable(F.col("v")) & F.col("label").isNotNull())
    classes = stage(
        valid.groupBy("label", "v").agg(F.min("id").alias("least"), F.count("*").alias("n"))
        .withColumn("cid", F.monotonically_increasing_id()).withColumn("dim", F.size("v")),
        "vector-classes",
    )
    groups = stage(classes.select("label", "dim").distinct().withColumn("grp", F.monotonically_increasing_id()), "vector-groups")
    found = stage(cosine_links(classes.join(groups, ["label", "dim"]), threshold, block), "vector-links")
    linked = found.groupBy("cid").agg(F.sum("linked").alias("linked"))
    comps = connected_components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    answer = classes.select("label", "v", "cid", "least", "n").join(linked, "cid", "left").join(
        comps.withColumnRenamed("node", "cid"), "cid", "left"
    ).withColumn("component", F.coalesce("component", "cid"))
    smallest = answer.groupBy("component").agg(F.min("least").alias("component_id"))
    answer = answer.join(smallest, "component").select(
        "label", "v", "component_id", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.lit(True).alias("valid")
    )
    return rows.join(answer, ["label", "v"], "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("valid"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    ).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def query(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
