"""Ordinal encoding of text columns, without the labels on the driver.

Labels are ordered by frequency (most frequent = 0), ties alphabetically. The
distinct labels are counted and dealt out by ranges of (count descending,
label); a label's index is its place in its partition plus the sizes of the
partitions before it, so neither the driver nor one task holds a column's
labels, also if all share a count or a beginning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripkiln import config as C
from tripkiln.sources.staging import stage

_LABEL, _COUNT, _PART, _PLACE, _BASE = "__tk_label", "__tk_count", "__tk_part", "__tk_place", "__tk_base"


def label_indices(df: DataFrame, column: str, index: str) -> DataFrame:
    """``(label, index)`` of every non-null label of ``column``."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias(_LABEL)).agg(F.count(F.lit(1)).alias(_COUNT))
    # by ranges of the index order: also labels of one count, and with one beginning, are spread
    ranged = counts.repartitionByRange(F.desc(_COUNT), F.asc(_LABEL))
    # staged: the ranges are drawn from a sample and must be the same for places and sums
    parts = stage(ranged.withColumn(_PART, F.spark_partition_id()), "labels")
    sizes = parts.groupBy(_PART).agg(F.count(F.lit(1)).alias(_BASE))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    bases = sizes.withColumn(_BASE, F.coalesce(F.sum(_BASE).over(before), F.lit(0)))
    place = F.row_number().over(Window.partitionBy(_PART).orderBy(F.desc(_COUNT), _LABEL)) - 1
    return parts.withColumn(_PLACE, place).join(F.broadcast(bases), _PART).select(
        _LABEL, (F.col(_BASE) + F.col(_PLACE)).cast("double").alias(index)
    )


def encode_ordinal(
    df: DataFrame,
    columns: tuple[str, ...] = C.ORDINAL_ENCODING_COLUMNS,
    suffix: str = "_index",
) -> DataFrame:
    """Append ``<column><suffix>`` (double); nulls get the next free index."""
    out = df
    for c in columns:
        if c not in df.columns:
            continue
        index = c + suffix
        labels = label_indices(df, c, index)
        n_labels = F.coalesce(df.select(F.col(c)).where(F.col(c).isNotNull()).distinct().agg(F.count(F.lit(1))).scalar(), F.lit(0))
        out = out.join(labels, out[c] == labels[_LABEL], "left").drop(_LABEL)
        out = out.withColumn(index, F.coalesce(F.col(index), n_labels.cast("double")))
    return out
