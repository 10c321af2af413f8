"""Mixing sources to target weights by min-cost flow.

A document may belong to several sources. Documents are aggregated by
membership pattern; the patterns' tokens are routed to the sources' quotas by
a flow whose cost is convex in repetition (the second use of a token costs
more than any first use), and each pattern's share is then filled with
documents in a seeded order. Spark does everything that grows with the
documents; the driver sees one row a source and one a membership pattern.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripkiln.llm.common import fresh, size_udf, small_batches, stage, table

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEATS = 2
SEED = 17
#: Tables of sources and patterns up to this size are broadcast.
BROADCAST_ROWS = 20_000
#: So few documents are chosen by exact sums; more come near their need by exchanges.
EXACT_ITEMS = 64
EXACT_SUM = 2_000_000


def water_fill(weights: Sequence[float], sizes: Sequence[int], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size; what
    is cut off is shared again by weight among the others."""
    out = [0.0] * len(sizes)
    open_, left = set(range(len(sizes))), float(total)
    while open_:
        weight = sum(weights[i] for i in open_)
        full = {i for i in open_ if left * weights[i] / weight >= most * sizes[i]}
        if not full:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in full:
            out[i] = float(most * sizes[i])
        left -= sum(out[i] for i in full)
        open_ -= full
    return out


def min_cost_flow(patterns: dict[tuple[int, ...], int], quotas: dict[int, int], repeats: int) -> dict[tuple, dict[int, int]]:
    """Tokens that each pattern gives to each of its sources.

    The k-th use of a pattern's tokens costs k - 1 and the arcs to sources
    are free, so successive shortest paths are: augment from patterns with
    first uses left until none reaches an open quota, then allow second uses,
    and so on. Paths may take tokens back from a source that another pattern
    can serve. Integral; cost-minimal among the flows of its value."""
    flow: dict[tuple, dict[int, int]] = {p: {} for p in patterns}
    open_quota = dict(quotas)
    givers: dict[int, set] = {s: set() for s in quotas}

    def push(p: tuple, s: int, amount: int) -> None:
        flow[p][s] = flow[p].get(s, 0) + amount
        (givers[s].add if flow[p][s] else givers[s].discard)(p)

    for _ in range(repeats):
        for start in sorted(patterns):
            spare = patterns[start]
            while spare:
                # shortest path start -> ... -> a source with open quota
                came: dict = {("p", start): None}
                queue, goal = deque([("p", start)]), None
                while queue and goal is None:
                    kind, x = node = queue.popleft()
                    if kind == "p":
                        after = [("s", s) for s in x if s in quotas]
                    else:
                        if open_quota[x] > 0:
                            goal = node
                            break
                        after = [("p", p) for p in sorted(givers[x])]
                    for n in after:
                        if n not in came:
                            came[n] = node
                            queue.append(n)
                if goal is None:
                    break
                path = [goal]
                while came[path[-1]] is not None:
                    path.append(came[path[-1]])
                path.reverse()
                back = [(path[i + 1][1], path[i][1]) for i in range(1, len(path) - 1, 2)]
                amount = min([spare, open_quota[goal[1]], *(flow[p][s] for p, s in back)])
                for i in range(0, len(path) - 1, 2):
                    push(path[i][1], path[i + 1][1], amount)
                for p, s in back:
                    push(p, s, -amount)
                spare -= amount
                open_quota[goal[1]] -= amount
    return flow


def exact_fill(sizes: np.ndarray, need: int) -> np.ndarray:
    """The subset whose sum is nearest to ``need`` (of equals the smaller
    sum), by the set of reachable sums as bits."""
    items = [int(n) for n in sizes]
    reach = [1]
    for n in items:
        reach.append(reach[-1] | reach[-1] << n)
    below = (reach[-1] & ((1 << (need + 1)) - 1)).bit_length() - 1
    above = reach[-1] >> need
    above = need + (above & -above).bit_length() - 1 if above else None
    at = above if above is not None and above - need < need - below else below
    taken = np.zeros(len(items), bool)
    for i in range(len(items) - 1, -1, -1):
        if not reach[i] >> at & 1:
            taken[i], at = True, at - items[i]
    return taken


def fill_to(sizes: np.ndarray, need: int, swaps: int = 20) -> np.ndarray:
    """Which items to take so that their sizes come near ``need``: in order
    while they fit, then single changes and exchanges that come nearer."""
    if len(sizes) <= EXACT_ITEMS and sizes.sum() <= EXACT_SUM:
        return exact_fill(sizes, need)
    taken = np.zeros(len(sizes), bool)
    left = need
    for i, n in enumerate(sizes.tolist()):
        if 0 < n <= left:
            taken[i], left = True, left - n
    for _ in range(swaps):
        out, free = np.flatnonzero(taken), np.flatnonzero(~taken & (sizes > 0))
        if not left or not len(free):
            break
        free = free[np.argsort(sizes[free], kind="stable")]
        give = np.append(out, -1)  # -1: nothing goes
        wanted = left + np.append(sizes[out], 0)
        at = np.searchsorted(sizes[free], wanted)
        best = (abs(left), -1, -1)
        for near in (at - 1, at):
            ok = (near >= 0) & (near < len(free))
            miss = np.abs(wanted[ok] - sizes[free[near[ok]]])
            if len(miss) and miss.min() < best[0]:
                k = int(miss.argmin())
                best = (int(miss[k]), int(give[ok][k]), int(free[near[ok][k]]))
        if best[2] < 0:
            break
        taken[best[2]] = True
        left -= int(sizes[best[2]])
        if best[1] >= 0:
            taken[best[1]] = False
            left += int(sizes[best[1]])
    return taken


def _fill(size: str, h: str, owed: str, copies: str):
    """Seeded fill of what a boundary bucket still owes its pattern."""

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([h, size], kind="stable")
        return pdf.assign(**{copies: pdf[copies] + fill_to(pdf[size].to_numpy(), int(pdf[owed].iloc[0])).astype(int)})

    return fill


def mix(
    rows: DataFrame, size: str, sources: str, targets: dict[int, float], key: Sequence[str],
    repeats: int = MAX_REPEATS, seed: int = SEED, copies: str = "copies",
) -> DataFrame:
    """``rows`` with how often the mix takes each one (``copies``, 0 to
    ``repeats``).

    ``sources``: column with the row's source numbers (array of int);
    ``targets``: tokens wanted of each source. ``key``: columns that seed the
    order (rows equal in them are interchangeable). Rows of size 0 or of no
    source are never taken. Every pattern's tokens come within half a document
    of the boundary bucket of its routed tokens."""
    pat, h, bucket, need, base, nb, cum, total = fresh(
        rows.columns + [copies], "pat", "h", "bucket", "need", "base", "nb", "cum", "total"
    )
    edge_no, owed = fresh(rows.columns + [copies], "edge", "owed")
    spark = rows.sparkSession
    rows = rows.withColumn(pat, F.array_sort(F.array_distinct(sources))).withColumn(
        h, F.xxhash64(F.lit(seed), *[F.col(k) for k in key])
    )
    stats = rows.groupBy(pat).agg(F.sum(size).alias("size"), F.count("*").alias("n")).collect()
    patterns = {tuple(r[pat]): int(r["size"] or 0) for r in stats}
    flow = min_cost_flow(
        {p: s for p, s in patterns.items() if s}, {s: round(t) for s, t in targets.items()}, repeats
    )
    # sqrt-many buckets of sqrt-many documents: neither the bucket totals nor a bucket is large
    plan = []
    for r in stats:
        p = tuple(r[pat])
        wanted, have = sum(flow.get(p, {}).values()), patterns[p]
        whole = wanted // have if have else 0
        plan.append((list(p), int(whole), int(wanted - whole * have), max(1, int(r["n"] ** 0.5 / 4))))
    planned = spark.createDataFrame(plan, f"{pat} array<int>, {base} int, {need} long, {nb} int")
    rows = rows.join(_small(planned, len(plan)), pat).withColumn(bucket, F.pmod(h, nb).cast("int"))
    sums = rows.where(F.col(need) > 0).groupBy(pat, bucket).agg(F.sum(size).alias(total), F.first(need).alias(need))
    before = Window.partitionBy(pat).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    edge = (
        sums.withColumn(cum, F.coalesce(F.sum(total).over(before), F.lit(0)))
        .where((F.col(cum) < F.col(need)) & (F.col(cum) + F.col(total) >= F.col(need)))
        .select(pat, F.col(bucket).alias(edge_no), (F.col(need) - F.col(cum)).alias(owed))
    )
    edge = stage(edge, "mix-edges")  # one row a pattern
    placed = rows.join(edge, pat, "left")
    sure = placed.where(F.col(edge_no).isNull() | (F.col(bucket) != F.col(edge_no))).withColumn(
        copies, F.col(base) + F.coalesce((F.col(bucket) < F.col(edge_no)).cast("int"), F.lit(0))
    )
    unsure = placed.where(F.col(bucket) == F.col(edge_no)).withColumn(copies, F.col(base))
    filled = unsure.groupBy(pat).applyInPandas(_fill(size, h, owed, copies), unsure.schema)
    out = sure.unionByName(filled)
    return out.withColumn(copies, F.when(F.col(size) > 0, F.col(copies)).otherwise(0)).select(
        *[c for c in rows.columns if c not in (pat, h, base, need, nb, bucket)], copies
    )


def _small(df: DataFrame, rows: int) -> DataFrame:
    """A table made from ``rows`` driver rows: broadcast up to a bound."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def source_sizes(rows: DataFrame, source: str, size: str) -> list[tuple[str | None, int]]:
    """Sources by code point, null last, with their sizes (on the driver: one
    row a source)."""
    found = [(r[0], int(r[1] or 0)) for r in rows.groupBy(source).agg(F.sum(size)).collect()]
    return sorted(found, key=lambda x: (x[0] is None, x[0] or ""))


def mix_by_source(
    docs: DataFrame, source: str = "source", text: str = "text", id_col: str = "doc_id",
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeats: int = MAX_REPEATS, seed: int = SEED,
    drop_text: bool = False,
) -> DataFrame:
    """``docs`` with ``size`` (words), ``source_size``, ``target`` (of its
    source) and ``copies``: sources weigh ``weights`` in turn and share
    ``share`` times all words, none more than ``repeats`` times its own.
    Columns of these names that ``docs`` already has are replaced; with
    ``drop_text`` the text is left out. Null and empty texts have size 0 and
    are never taken; a null source is a source; every row, repeated ones too,
    gets its own number of copies. The rows are written once, and each
    later step reads the columns it needs from there."""
    small_batches(docs.sparkSession)
    named = {"size", "source_size", "target", "copies"} | ({text.lower()} if drop_text else set())
    keep = [c for c in docs.columns if c.lower() not in named]
    th, name, no, members = fresh(docs.columns + sorted(named), "th", "name", "no", "members")
    rows = stage(docs.select(*keep, size_udf(text).alias("size"), F.xxhash64(text).alias(th)), "mix")
    found = source_sizes(rows, source, "size")
    targets = water_fill([weights[i % len(weights)] for i in range(len(found))], [n for _, n in found], share * sum(n for _, n in found), repeats)
    known = rows.sparkSession.createDataFrame(
        [(s, i, n, t) for i, ((s, n), t) in enumerate(zip(found, targets))],
        f"{name} string, {no} int, source_size long, target double",
    )
    numbered = rows.join(_small(known, len(found)), F.col(source).eqNullSafe(F.col(name))).withColumn(members, F.array(no))
    taken = mix(numbered, "size", members, dict(enumerate(targets)), [id_col, th], repeats, seed)
    return taken.select(*keep, "size", "source_size", "target", "copies")


def take(docs: DataFrame, **params) -> DataFrame:
    """The mixed corpus: every document as often as the mix takes it."""
    mixed = mix_by_source(docs, **params)
    (n,) = fresh(mixed.columns, "n")
    return mixed.withColumn(n, F.explode(F.sequence(F.lit(0), F.col("copies")))).where(F.col(n) > 0).select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix_by_source(docs, drop_text=True).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )
