"""Data quality: repeated rows and outliers.

Repeated rows are reduced by a partially aggregated minimum, so a key that
holds a third of all rows is combined before the shuffle and never meets in
one task, unlike a ranking window. Quantiles are exact: distinct values are
counted, dealt out by ranges, and a value's rank is its place in its range
plus the counts of the ranges before, so no task holds a column's values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripkiln.schema import numeric_columns
from tripkiln.sources.staging import stage

#: Spans between the quartiles that a value may lie outside of them.
FENCE = 1.5


def drop_repeated(df: DataFrame, keys: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """One row for each combination of ``keys`` (all columns by default): the
    least by ``order``, then by the other columns; nulls are equal to each
    other and come first. Columns and their order stay."""
    if not keys or set(keys) == set(df.columns):
        return df.dropDuplicates()
    order = [c for c in order or [] if c not in keys]
    rest = order + [c for c in df.columns if c not in keys and c not in order]
    least = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__tk_row"))
    return least.select(*[F.col(c) if c in keys else F.col("__tk_row")[c].alias(c) for c in df.columns])


def quantiles(df: DataFrame, columns: list[str], shares: list[tuple[int, int]]) -> DataFrame:
    """``name, n, q``: for every column with a value the least values that
    these shares of its ``n`` values (as fractions) do not exceed. Null and
    NaN are no values; numbers are read as doubles."""
    pairs = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "name", "value")
    pairs = pairs.where(F.col("value").isNotNull() & ~F.isnan("value"))
    counts = pairs.groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    # staged: the ranges are drawn from a sample and must be the same for ranks and sums
    parts = stage(counts.repartitionByRange("name", "value").withColumn("part", F.spark_partition_id()), "values")
    sums = parts.groupBy("name", "part").agg(F.sum("n").alias("in_part"))  # one row a column and range
    before = Window.partitionBy("name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(
        "name", "part", F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("base"),
        F.sum("in_part").over(Window.partitionBy("name")).alias("total"),
    )
    here = Window.partitionBy("part", "name").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = parts.withColumn("upto", F.sum("n").over(here)).join(F.broadcast(bases), ["name", "part"])
    rank = F.col("base") + F.col("upto")
    least = [F.min(F.when(rank * below >= F.col("total") * share, F.col("value"))) for share, below in shares]
    return ranked.groupBy("name").agg(F.max("total").alias("n"), F.array(*least).alias("q"))


def outlier_bounds(df: DataFrame, columns: list[str] | None = None, fence: float = FENCE) -> DataFrame:
    """``name, n, q1, q3, low, high`` of every numeric column with a value:
    its quartiles, and ``fence`` times their distance beyond them."""
    columns = numeric_columns(df.schema) if columns is None else list(columns)
    q = quantiles(df, columns, [(1, 4), (3, 4)]).select("name", "n", F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))
    far = (F.col("q3") - F.col("q1")) * fence
    return q.select("name", "n", "q1", "q3", (F.col("q1") - far).alias("low"), (F.col("q3") + far).alias("high"))


def flag_outliers(df: DataFrame, columns: list[str] | None = None, fence: float = FENCE) -> DataFrame:
    """``df`` with ``<column>_outlier``: the value lies outside its column's
    bounds (null for null and NaN). The bounds are one scalar subquery."""
    columns = numeric_columns(df.schema) if columns is None else list(columns)
    bounds = outlier_bounds(df, columns, fence)
    pick = [F.max(F.when(F.col("name") == c, F.struct("low", "high"))).alias(c) for c in columns]
    out = df.withColumn("__tk_bounds", bounds.agg(*pick).select(F.struct(*columns)).scalar())
    flags = {}
    for c in columns:
        value, b = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.col("__tk_bounds")[c]
        flags[f"{c}_outlier"] = (value < b["low"]) | (value > b["high"])
    return out.withColumns(flags).drop("__tk_bounds")


def drop_outliers(df: DataFrame, columns: list[str] | None = None, fence: float = FENCE) -> DataFrame:
    """Rows without an outlier in ``columns``; unknown values stay."""
    columns = numeric_columns(df.schema) if columns is None else list(columns)
    flagged = flag_outliers(df, columns, fence)
    for c in columns:
        flagged = flagged.where(F.coalesce(~F.col(f"{c}_outlier"), F.lit(True)))
    return flagged.select(*df.columns)
