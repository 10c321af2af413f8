"""Best-fit packing of sequences into bins of several permitted lengths.

Lengths are bounded by the longest bin, so the histogram of lengths is a
small table however many sequences there are. The packing is decided on the
histogram, longest first: sequences go to the open bins they fit best; where
none fits, the permitted length whose filling (looked ahead over the lengths
still to place) costs least per token is opened, for as many bins at once as
the counts allow; at the end every bin shrinks to the shortest permitted
length that holds its contents. Equal sequences are interchangeable, so the
result is a short list of runs "sequences a..b of this length go to bins
s, s+1, ... at this offset", and Spark applies it to all rows by their number
within their length.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkiln.llm.common import fresh, size_udf, small_batches, table
from tripkiln.llm.sharding import assign_slots

BIN_SIZES = (512, 1024, 2048, 4096)


def bin_cost(size: int) -> float:
    """Cost of one bin: a term per token, one for attention, one per sequence."""
    return size * (1 + size / 16384) + 64


@dataclass
class Run:
    """``count`` sequences of one length from number ``first`` on go to bins
    ``bin``, ``bin`` + 1, ..., ``each`` side by side a bin from ``offset`` on."""

    length: int
    first: int
    count: int
    bin: int
    each: int
    offset: int


def pack_histogram(
    counts: dict[int, int], sizes: Sequence[int] = BIN_SIZES, cost: Callable[[int], float] = bin_cost
) -> tuple[list[Run], list[tuple[int, int, int]]]:
    """Runs, and ``(first bin, number of bins, size)`` of equal bins."""
    sizes = sorted(sizes)
    lengths = sorted(n for n, c in counts.items() if c)
    if lengths and (lengths[0] <= 0 or lengths[-1] > sizes[-1]):
        raise ValueError("lengths must be between 1 and the longest bin")
    left = {n: counts[n] for n in lengths}
    # open bins by free space: lists of (first bin, bins, capacity)
    free: dict[int, list[tuple[int, int, int]]] = {}
    spaces: list[int] = []
    runs: list[Run] = []
    bins = 0

    def put(space: int, group: tuple[int, int, int]) -> None:
        if space not in free:
            bisect.insort(spaces, space)
            free[space] = []
        free[space].append(group)

    def pop(space: int) -> tuple[int, int, int]:
        group = free[space].pop()
        if not free[space]:
            del free[space]
            spaces.remove(space)
        return group

    def filled(size: int, upto: int) -> int:
        """Tokens in a bin of ``size`` that takes what is left, longest first."""
        space, n = size, upto
        while n >= 0 and space:
            n = min(n, bisect.bisect_right(lengths, space) - 1)
            if n < 0:
                break
            space -= min(space // lengths[n], left[lengths[n]]) * lengths[n]
            n -= 1
        return size - space

    for n in range(len(lengths) - 1, -1, -1):
        length, done = lengths[n], 0
        while left[length]:
            at = bisect.bisect_left(spaces, length)
            if at < len(spaces):  # the open bins that it fits best
                space = spaces[at]
                first, number, size = pop(space)
            else:
                space = size = min((s for s in sizes if s >= length), key=lambda s: (cost(s) / filled(s, n), s))
                first, number = bins, max(1, left[length] // (size // length))
                bins += number
            each = min(space // length, left[length])
            used = min(number, left[length] // each)
            runs.append(Run(length, done, used * each, first, each, size - space))
            done += used * each
            left[length] -= used * each
            put(space - each * length, (first, used, size))
            if used < number:
                put(space, (first + used, number - used, size))
    groups = sorted(
        (first, number, sizes[bisect.bisect_left(sizes, size - space)])
        for space, found in free.items()
        for first, number, size in found
    )
    return runs, groups


def run_rows(runs: list[Run], groups: list[tuple[int, int, int]]) -> list[tuple[int, ...]]:
    """Runs cut so that the bins of each have one final size:
    ``(length, first, count, bin, each, offset, size)``."""
    begins = [g[0] for g in groups]
    out = []
    for r in runs:
        bin_, stop = r.bin, r.bin + r.count // r.each
        while bin_ < stop:
            first, number, size = groups[bisect.bisect_right(begins, bin_) - 1]
            upto = min(stop, first + number)
            out.append((r.length, r.first + (bin_ - r.bin) * r.each, (upto - bin_) * r.each, bin_, r.each, r.offset, size))
            bin_ = upto
    return out


def pack(
    rows: DataFrame, size: str, sizes: Sequence[int] = BIN_SIZES, cost: Callable[[int], float] = bin_cost
) -> DataFrame:
    """``rows`` with ``piece``, ``start``, ``n_tokens``, ``bin_id``,
    ``bin_size`` and ``bin_offset`` (these names are replaced if they exist).

    ``size`` is a row's number of tokens. A row longer than the longest bin is
    cut into full bins and a rest, one output row a piece (``start``: tokens
    before it). A row of size 0 or null comes back with null bin columns.
    Equal lengths are placed in the order of the input's tasks and rows."""
    new = ["piece", "start", "n_tokens", "bin_id", "bin_size", "bin_offset"]
    keep = [c for c in rows.columns if c.lower() not in new]
    total, no, run = fresh(keep + new, "total", "no", "run")
    most = max(sizes)
    pieces = (
        rows.select(*keep, F.coalesce(F.col(size), F.lit(0)).cast("long").alias(total))
        .withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col(total) / most) - 1, F.lit(0)).cast("int"))))
        .withColumn("start", (F.col("piece") * F.lit(most)).cast("long"))
        .withColumn("n_tokens", F.least(F.lit(most), F.col(total) - F.col("start")).cast("int"))
        .drop(total)
    )
    pieces = assign_slots(pieces, "n_tokens", no)
    histogram = pieces.where("n_tokens > 0").groupBy("n_tokens").agg(F.count("*").alias(no)).collect()
    planned = run_rows(*pack_histogram({int(r[0]): int(r[1]) for r in histogram}, sizes, cost))
    # bounded by the lengths, not by the rows
    table_ = rows.sparkSession.createDataFrame(
        [(x[0], x[1:]) for x in planned],
        f"n_tokens int, {run} struct<first: long, count: long, bin: long, each: int, offset: int, size: int>",
    )
    r = F.col(run)
    here = (F.col(no) >= r["first"]) & (F.col(no) < r["first"] + r["count"])
    placed = pieces.join(F.broadcast(table_), (pieces["n_tokens"] == table_["n_tokens"]) & here, "left").drop(table_["n_tokens"])
    nth = F.col(no) - r["first"]
    return placed.select(
        *keep, "piece", "start", "n_tokens",
        (r["bin"] + F.floor(nth / r["each"])).cast("long").alias("bin_id"),
        r["size"].alias("bin_size"),
        (r["offset"] + F.pmod(nth, r["each"]) * F.col("n_tokens")).cast("int").alias("bin_offset"),
    )


def pack_documents(docs: DataFrame, text: str = "text", sizes: Sequence[int] = BIN_SIZES) -> DataFrame:
    """The documents' word counts packed; texts themselves are not moved."""
    small_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c != text]
    (size,) = fresh(docs.columns, "size")
    return pack(docs.select(*keep, size_udf(text).alias(size)), size, sizes).drop(size)


def query(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
