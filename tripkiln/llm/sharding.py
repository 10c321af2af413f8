"""Rendezvous hashing of stable record keys over weighted shards.

Every row scores each shard from its key alone, ``-w / ln(u(key, shard))``
with ``u`` uniform in (0, 1), and goes to the highest score: shards receive
rows in proportion to their weights, and a shard that is added or removed
takes or gives only its own rows. All of it is one projection of built-in
functions; no state, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripkiln.llm.common import fresh, stage, table


def shard_score(key: Column, shard: int, weight: float = 1.0) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(int(shard))), 11).cast("double")
    uniform = (bits + F.lit(0.5)) * F.lit(2.0**-53)
    return F.lit(float(weight)) / -F.log(uniform)


def rendezvous_shard(key: Column, weights: Sequence[float] | int) -> Column:
    """The shard (int) of a key. ``weights``: one positive weight a shard, or
    the number of equal shards. A null key is a key like any other: all such
    rows share a shard. Equal scores: the smaller shard."""
    ws = [1.0] * weights if isinstance(weights, int) else [float(w) for w in weights]
    if not ws or min(ws) <= 0:
        raise ValueError("shards need positive weights")
    ranked = F.array_max(
        F.array(*[F.struct(shard_score(key, s, w).alias("score"), F.lit(-s).alias("no")) for s, w in enumerate(ws)])
    )
    return (-ranked["no"]).cast("int")


def assign_shards(df: DataFrame, key: str, weights: Sequence[float] | int, shard: str = "shard") -> DataFrame:
    return df.withColumn(shard, rendezvous_shard(F.col(key), weights))


def assign_slots(df: DataFrame, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """Gapless row numbers from 0 within each shard, in the order of the
    input's tasks and rows.

    The rows are written once with their task and position, numbered within
    (shard, task), and shifted by the counts of the tasks before: no task
    sees more than one task's input again, however many rows share a shard
    or a key. Row order of an input read from the same files is stable."""
    task, pos, base = fresh(df.columns, "task", "pos", "base")
    rows = stage(df.withColumn(task, F.spark_partition_id()).withColumn(pos, F.monotonically_increasing_id()), "shard")
    counts = rows.groupBy(shard, task).agg(F.count("*").alias(base))
    before = Window.partitionBy(shard).orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn(base, F.coalesce(F.sum(base).over(before), F.lit(0)))
    within = Window.partitionBy(shard, task).orderBy(pos)
    return (
        rows.withColumn(slot, F.row_number().over(within) - 1)
        .join(bases, [shard, task])
        .withColumn(slot, (F.col(slot) + F.col(base)).cast("long"))
        .select(*df.columns, slot)
    )


def write_shards(df: DataFrame, path: str, key: str, weights: Sequence[float] | int) -> None:
    """Write rows as one folder a shard (``shard=0``, ...); several files a
    folder, so no shard passes through one task."""
    assign_shards(df, key, weights).write.partitionBy("shard").parquet(path)


N_SHARDS = 16


def query(spark, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 15 by doc_id, with the shard that one more
    shard would give."""
    docs = table(spark, sf_dir, "documents")
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id",
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous_shard(F.col("doc_id"), N_SHARDS).alias("shard"),
        rendezvous_shard(F.col("doc_id"), N_SHARDS + 1).alias("grown_shard"),
    )
    return assign_slots(rows).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
