"""Small helpers shared by the operators."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripkiln.sources.staging import remove, stage

__all__ = ["drop_stage", "fresh", "ranges", "size_udf", "small_batches", "sorted_groups", "stage", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(columns: Iterable[str], *wanted: str) -> list[str]:
    """Working column names that clash with none of ``columns`` (Spark
    compares names without case)."""
    taken = {c.lower() for c in columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def drop_stage(df: DataFrame) -> None:
    """Delete the folder of a staged DataFrame that nothing reads any more."""
    for path in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
        remove(df.sparkSession, path)


#: Bytes of texts in a batch between Spark and a Python worker.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Let batches of texts end at ``BATCH_BYTES``.

    Spark's own limits (10,000 rows, 64 MB) hold tens of MB of texts a task
    several times over: in Spark's buffers, in the worker's and in what it
    makes of them. A lower limit that the session has already is kept."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    has = re.fullmatch(r"(\d+)([kmgt]?)b?", spark.conf.get(limit, "64m").lower())
    if not has or not 0 < int(has[1]) << 10 * " kmgt".index(has[2] or " ") <= BATCH_BYTES:
        spark.conf.set(limit, str(BATCH_BYTES))


def ranges(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for each n of ``lengths``, one after the other."""
    lengths = np.asarray(lengths, dtype=np.int64)
    total = int(lengths.sum())
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.arange(total, dtype=np.int64) - starts


def sorted_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str], min_rows: int = 20_000
) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that arrive sorted by ``keys``.

    The last, possibly unfinished group of what has been read waits for the
    next batch, so memory is one batch plus one group (callers bound the
    groups). Several small batches are joined to tables of ``min_rows``."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < min_rows:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        cut = _last_group_start(t, keys)
        if cut:
            yield t.slice(0, cut)
            rest = t.slice(cut)
            held, rows = rest.to_batches(), 0
        else:
            held = t.to_batches()
            rows = 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _last_group_start(t: pa.Table, keys: list[str]) -> int:
    same = np.ones(t.num_rows, dtype=bool)
    for k in keys:
        col = t.column(k).to_numpy()
        same &= col == col[-1]
    return 0 if same.all() else int(np.flatnonzero(~same)[-1]) + 1


@F.arrow_udf(T.LongType())
def _words(texts: pa.Array) -> pa.Array:
    sizes = (len((t.as_py() or b"").split()) for t in texts)  # one text at a time
    return pa.array(np.fromiter(sizes, np.int64, len(texts)))


def size_udf(text: Column | str) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs of a text (null: 0). The split
    of bytes at ASCII white space is exactly this class."""
    col = F.col(text) if isinstance(text, str) else text
    return _words(col.cast("binary"))
