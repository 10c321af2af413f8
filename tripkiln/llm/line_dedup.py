"""Removal of repeated passages of two or more lines.

Every adjacent pair of a text's lines is hashed (blank lines between them
belong to the pair). A pair that occurs before, in the same or in another
document, marks its two lines; all pairs of a repeated passage are marked, so
it goes from its first to its last line, wherever it stands and however short
it is. A line of over 50 words counts as its sentences, and a sentence of over
50 words is marked by itself. Every line stays where it occurs first. Equality is decided by
comparing bytes, the hashes only find the candidates.

``chunks`` cuts a text into content-defined chunks: a rolling hash over the
last few line hashes decides after which lines one ends. Every chunk of two or
more lines that are not blank consists of pairs, so the pairs find all that
repeated chunks find.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripkiln.llm.common import drop_stage, fresh, small_batches, stage, table

#: Line hashes in the rolling hash.
WINDOW = 2
#: A boundary after one line in so many, on average.
DIVISOR = 3
MIN_LINES = 2
MAX_LINES = 16
#: Repeated hashes up to this many are broadcast to the comparison (8 bytes each); the places of more are joined to their texts.
BROADCAST_HASHES = 1_000_000
#: Known pairs up to this many are broadcast with their first places (about 40 bytes each).
BROADCAST_PLACES = 200_000
#: A line of more words is cut into sentences; a sentence of more words is a passage by itself.
LONG_WORDS = 50
_SENTENCE_GAP = re.compile(rb"(?<=[.!?])[ \t]+")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def chunk_bounds(lines: list[bytes]) -> list[int]:
    """Ends of the chunks (numbers of lines): content-defined, between
    ``MIN_LINES`` and ``MAX_LINES`` long; a rest shorter than ``MIN_LINES``
    belongs to the chunk before it."""
    n = len(lines)
    if n <= MIN_LINES:
        return [n]
    h = np.fromiter((xxhash.xxh64_intdigest(x) for x in lines), np.uint64, n)
    rolled = h * _FACTOR
    for back in range(1, WINDOW):
        h = np.concatenate([[np.uint64(0)], h[:-1]])
        rolled = (rolled + h) * _FACTOR
    cuts = ((rolled >> np.uint64(33)) % np.uint64(DIVISOR) == 0).tolist()
    ends, begin = [], 0
    for i in range(n):
        size = i + 1 - begin
        if size >= MIN_LINES and (cuts[i] or size == MAX_LINES):
            ends.append(i + 1)
            begin = i + 1
    if begin < n:
        if ends and n - begin < MIN_LINES:
            ends[-1] = n
        else:
            ends.append(n)
    return ends


def chunks(text: bytes) -> list[bytes]:
    """The text's chunks; joined by newlines they are the text."""
    lines = text.split(b"\n")
    out, begin = [], 0
    for end in chunk_bounds(lines):
        out.append(b"\n".join(lines[begin:end]))
        begin = end
    return out


def line_units(line: bytes) -> list[tuple[int, int]]:
    """Begin and end of a line's units: the line itself, or the sentences of
    one of over ``LONG_WORDS`` words. A blank line has none."""
    if not line or line.isspace():
        return []
    begin, out = 0, []
    if len(line) > 2 * LONG_WORDS and len(line.split()) > LONG_WORDS:
        for gap in _SENTENCE_GAP.finditer(line):
            if not line[gap.end() :].strip():
                break
            out.append((begin, gap.start()))
            begin = gap.end()
    return [*out, (begin, len(line))]


def units(text: bytes) -> list[tuple[int, int]]:
    """Begin and end of a text's units."""
    out, at = [], 0
    for line in text.split(b"\n"):
        out += [(at + begin, at + end) for begin, end in line_units(line)]
        at += len(line) + 1
    return out


def _occurrences(with_bytes: bool):
    """The adjacent pairs of units, and single units of over ``LONG_WORDS``
    words: where they are (numbers of the first and the last unit), or their bytes."""

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows, first, last, hashes, bodies = [], [], [], [], []
                for r, text in enumerate(part.column(2).to_pylist()):
                    found = units(text or b"")
                    for i, (begin, end) in enumerate(found):
                        alone = end - begin > 2 * LONG_WORDS and len(text[begin:end].split()) > LONG_WORDS
                        for j in range(i if alone else i + 1, min(i + 2, len(found))):
                            body = text[begin : found[j][1]]
                            rows.append(r)
                            first.append(i)
                            last.append(j)
                            hashes.append(xxhash.xxh64_intdigest(body))
                            if with_bytes:
                                bodies.append(body)
                take = pa.array(rows, pa.int64())
                found = pa.array(np.array(hashes, np.uint64).view(np.int64))
                cols, names = [found, pa.array(bodies, pa.binary())], ["hash", "body"]
                if not with_bytes:
                    place = [pa.array(first, pa.int32()), pa.array(last, pa.int32())]
                    cols, names = [part.column(0).take(take), part.column(1).take(take), *place, found], ["id", "rk", "idx", "last", "hash"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return occurrences


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes and bytes of a text's units ``idx`` to ``last``."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            bodies = []
            for text, first, last in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                found = units(text or b"")
                # two texts may share id and hash, and so their places
                bodies += [text[found[i][0] : found[j][1]] for i, j in zip(first, last) if j < len(found)]
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, bodies), np.uint64, len(bodies))
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(bodies, pa.binary())], names=["hash", "body"])


def without_units(text: bytes, gone: set[int]) -> tuple[bytes, int]:
    """The text without these units and the blank lines between them, and how
    many runs of units were cut."""
    out, at = [], 0
    for line in text.split(b"\n"):
        spans = line_units(line)
        kept = [k for k in range(len(spans)) if at + k not in gone]
        if len(kept) == len(spans):
            if spans or not {at - 1, at} <= gone:
                out.append(line)
        elif kept:  # sentences keep the space behind them, but for the last
            ends = [spans[k + 1][0] for k in kept[:-1]] + [spans[kept[-1]][1]]
            out.append(b"".join(line[spans[k][0] : end] for k, end in zip(kept, ends)))
        at += len(spans)
    return b"\n".join(out), sum(i - 1 not in gone for i in gone)


@F.pandas_udf(T.StructType([T.StructField("text", T.BinaryType()), T.StructField("n", T.IntegerType())]))
def _without(texts: pd.Series, dropped: pd.Series) -> pd.DataFrame:
    def rest(text, drop):
        return without_units(text, set(drop))

    out = [(t, 0) if t is None or d is None else rest(t, d) for t, d in zip(texts, dropped)]
    return pd.DataFrame(out, columns=["text", "n"], dtype=object)


def drop_repeated_chunks(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with repeated passages of two or more lines removed from
    ``text``, and ``n_chunks_removed`` (runs of lines cut out) and
    ``all_removed`` (nothing is left of a text that had some); columns of
    these two names are replaced.

    "First" is by id (null last), then by the hash of the text, then by
    position; a pair that overlaps its first place stays. Rows equal in id and
    text are one document here: they keep and lose the same lines. Null texts
    stay null; blank lines alone and single lines of up to
    ``LONG_WORDS`` words are never removed. Two different pairs with one 64-bit hash are told apart by their bytes, and
    both stay."""
    small_batches(docs.sparkSession)
    new = ["n_chunks_removed", "all_removed"]
    keep = [c for c in docs.columns if c.lower() not in new]
    rk, dropped = fresh(docs.columns + new, "rk", "dropped")
    id_is, rk_is = F.col(id_col).alias("id"), F.xxhash64(F.col(text)).alias("rk")
    slim = docs.select(id_is, rk_is, F.col(text).cast("binary").alias("body"))
    id_type = dict(docs.select(id_is).dtypes)["id"]
    occ = stage(slim.mapInArrow(_occurrences(False), f"id {id_type}, rk long, idx int, last int, hash long"), "pairs")

    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "rk", "idx", "last")
    repeated = stage(
        occ.groupBy("hash").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n"), "repeated"
    )
    hashes = repeated.select("hash")
    if repeated.count() <= BROADCAST_HASHES:
        bodies = slim.mapInArrow(_occurrences(True), "hash long, body binary").join(F.broadcast(hashes), "hash", "left_semi")
    else:  # only the bytes of repeated pairs are shuffled here too
        places = occ.join(hashes, "hash", "left_semi").groupBy("id", "rk").agg(F.collect_list(F.struct("idx", "last")).alias("at"))
        places = stage(places.select(F.col("id").alias("id_"), F.col("rk").alias("rk_"), "at.idx", "at.last"), "places")
        there = slim.join(places.hint("merge"), slim["id"].eqNullSafe(places["id_"]) & (slim["rk"] == places["rk_"]))
        bodies = there.select("body", "idx", "last").mapInArrow(_bodies, "hash long, body binary")
    # byte comparison: a hash whose least and greatest bytes are the same stands for one text
    same = (
        bodies.groupBy("hash").agg(F.min("body").alias("least"), F.max("body").alias("most"))
        .where(F.col("least") == F.col("most"))
        .select("hash")
    )
    known = stage(repeated.join(same, "hash", "left_semi"), "same")
    if known.count() <= BROADCAST_PLACES:
        known = F.broadcast(known)
    here = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("rk") == F.col("first.rk"))
    removed = stage(
        occ.join(known, "hash").where(~here | (F.col("idx") > F.col("first.last")))
        .groupBy("id", "rk").agg(F.flatten(F.collect_list(F.sequence("idx", "last"))).alias("idx")),
        "removed",
    )
    for done in (occ, repeated, known):
        drop_stage(done)
    r = removed.select(F.col("id").alias("id_"), F.col("rk").alias("rk_"), F.col("idx").alias(dropped))
    r = r.hint("merge")  # grows with the documents: the same join at every size
    marked = docs.select(*keep, F.xxhash64(F.col(text)).alias(rk))
    joined = marked.join(r, marked[id_col].eqNullSafe(r["id_"]) & (marked[rk] == r["rk_"]), "left")
    (rest,) = fresh([*docs.columns, *new, rk, dropped], "rest")
    joined = joined.withColumn(rest, _without(F.when(F.col(dropped).isNotNull(), F.col(text).cast("binary")), F.col(dropped)))  # others stay in Spark
    left = F.when(F.col(dropped).isNull(), F.col(text)).otherwise(F.col(rest)["text"].cast("string"))
    return joined.select(
        *[left.alias(c) if c == text else F.col(c) for c in keep],
        F.when(F.col(dropped).isNull(), 0).otherwise(F.col(rest)["n"]).alias("n_chunks_removed"),
        (F.col(dropped).isNotNull() & (F.btrim(left, F.lit(" \t\r\n")) == "")).alias("all_removed"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = drop_repeated_chunks(docs)
    return out.select("doc_id", "text", "n_chunks_removed", F.length("text").cast("long").alias("n_chars_left"))
