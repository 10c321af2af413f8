"""Connected components by alternating large-star and small-star steps.

Edges stay distributed; each round is written to the shared checkpoint
folder, which cuts the lineage. A hub with any number of neighbours is an
aggregate (partial minimum per task) and an inner join that adaptive
execution can split, never one collected group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkiln.llm.common import drop_stage, stage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of ``edges`` (long columns ``a``
    and ``b``); the component is its smallest node. Loops and repeated edges
    are allowed, edges with a null end are ignored; no edges give no rows."""
    lo, hi = F.least(a, b), F.greatest(a, b)
    e = stage(
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(hi.alias("hi"), lo.alias("lo"))
        .distinct(),
        "edges",
    )
    state = _state(e)
    while state[0]:
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(e.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        root = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (
            large.join(root, "hi")
            .select(F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("x"))
            .select("x.hi", "x.lo")
            .where("hi != lo")
            .distinct()
        )
        after = stage(small, "edges")
        new = _state(after)
        drop_stage(e)
        e = after
        if new == state:
            break
        state = new
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(e.select("lo", "lo").distinct())
