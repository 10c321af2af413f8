"""Token ids in Huffman-coded files.

Ids are coded with one canonical, length-limited Huffman code built from the
counts of all ids of the corpus. A file row (a segment of whole documents)
holds its documents' ids and lengths and the coded ids in blocks of
``BLOCK_IDS``; the bit offset of every block is a checkpoint, so blocks
decode independently: a reader can start at any of them, and the decoder
runs all blocks of a segment in step through one lookup table.

Segments are rows of a Parquet table, so that any store Spark reaches can
hold them. ``codes`` beside it holds the code lengths, from which the
canonical code follows.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripkiln.llm.common import drop_stage, ranges, stage, table
from tripkiln.session import checkpoint_dir

#: Ids between two checkpoints.
BLOCK_IDS = 256
#: Ids after which a segment is closed (documents stay whole).
SEGMENT_IDS = 1 << 17
#: Longest code; a decoding table has two to this power entries.
MAX_CODE_BITS = 18
#: Distinct words whose ids a worker remembers before it forgets those that it met in one batch only.
WORD_CACHE = 500_000
#: Texts encoded together: up to so many, and about so many bytes.
ENCODED_TEXTS, ENCODED_BYTES = 2048, 4 << 20
#: Documents after which a segment may be closed.
SEGMENT_STEP = 512
END_ID = 2
TOKENIZER = "word_bpe_49k.json"


# -- code ------------------------------------------------------------------

def code_lengths(counts: np.ndarray, limit: int = MAX_CODE_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (more if that many
    symbols need more) by package-merge.

    Symbols with count 0 get length 0; a single symbol gets length 1."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    limit = max(limit, int(len(used) - 1).bit_length())
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.float64)
    n = len(used)
    # level by level: packages of two of the level below, merged with the symbols
    levels = []
    packages = np.empty(0)
    for _ in range(limit):
        items = np.concatenate([weights, packages])
        is_symbol = np.concatenate([np.ones(n, bool), np.zeros(len(packages), bool)])
        order = np.argsort(items, kind="stable")
        items, is_symbol = items[order], is_symbol[order]
        levels.append(is_symbol)
        even = len(items) // 2 * 2
        packages = items[:even:2] + items[1:even:2]
    # the cheapest 2n - 2 items of the top level; each package there takes two below
    take = 2 * n - 2
    for is_symbol in reversed(levels):
        symbols = int(is_symbol[:take].sum())
        lengths[used[:symbols]] += 1
        take = 2 * (take - symbols)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, symbol)."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    code = last = 0
    for n in range(1, int(lengths.max(initial=0)) + 1):
        code <<= n - last
        here = order[lengths[order] == n]
        codes[here] = code + np.arange(len(here))
        code, last = code + len(here), n
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Symbol and code length for every window of as many bits as the longest
    code."""
    bits = max(1, int(lengths.max(initial=0)))
    codes = canonical_codes(lengths).astype(np.int64)
    symbols, widths = np.zeros(1 << bits, np.uint32), np.zeros(1 << bits, np.uint8)
    used = np.flatnonzero(lengths)
    spans = 1 << (bits - lengths[used])
    at = np.repeat(codes[used] << (bits - lengths[used]), spans) + ranges(spans)
    symbols[at], widths[at] = np.repeat(used, spans), np.repeat(lengths[used], spans)
    return symbols, widths, bits


def encode_ids(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Coded ids (bits from the most significant on) and the bit offset of
    every block."""
    width = lengths[ids]
    end = np.cumsum(width)
    at = end - width
    code = codes[ids].astype(np.int64)
    # a code of up to 32 bits lies in one or two 32-bit words; the bits never overlap, so sums are unions
    words = int(end[-1] + 31) // 32 + 1 if len(ids) else 1
    shift = 64 - (at & 31) - width
    placed = code.astype(np.uint64) << shift.astype(np.uint64)
    word = at >> 5
    high = np.bincount(word, weights=(placed >> np.uint64(32)).astype(np.float64), minlength=words)
    low = np.bincount(word + 1, weights=(placed & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=words + 1)
    return (high + low[:words]).astype(np.uint64).astype(">u4").tobytes(), at[::BLOCK_IDS].astype(np.int64)


def decode_ids(data: bytes, checkpoints: np.ndarray, n_ids: int, decoder: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    """All ids of a segment: every block decodes from its checkpoint, all
    blocks one id at a time together."""
    symbols, widths, bits = decoder
    raw = np.frombuffer(data + b"\0\0\0\0\0\0\0\0", ">u4").astype(np.uint64)
    windows = (raw[:-1] << np.uint64(32)) | raw[1:]
    out = np.zeros((BLOCK_IDS, len(checkpoints)), np.uint32)
    at = np.array(checkpoints, np.int64)
    drop = np.uint64(64 - bits)
    last = n_ids - (len(checkpoints) - 1) * BLOCK_IDS  # ids of the last block
    for k in range(BLOCK_IDS if len(checkpoints) > 1 else last):
        if k == last:
            at = at[:-1]
        seen = (windows[at >> 5] << (at & 31).astype(np.uint64)) >> drop
        out[k, : len(at)] = symbols[seen]
        at = at + widths[seen]
    return out.T.reshape(-1)[:n_ids]


# -- tokens ----------------------------------------------------------------

_MARKS = ".,!?;:"
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Latin letters whose lower case is a Latin letter too.
_LETTERS = "".join(c for c in map(chr, range(0x250)) if c.lower().isalpha() and max(c.lower()) < "\u0250")
#: A plain word; punctuation marks may follow it in the text.
_PLAIN = f"^[{_LETTERS}]+$"


def _tails(words: pa.Array, bodies: pa.Array) -> pa.Array:
    """What the words have behind their beginnings ``bodies``."""
    cut = pc.binary_length(bodies).to_pylist()
    return pa.array([w[n:] for w, n in zip(words.view(pa.binary()).to_pylist(), cut)], pa.binary()).view(pa.string())


def _utf8(texts: list[bytes]) -> pa.Array:
    """As strings; bytes that are no UTF-8 become replacement characters."""
    try:
        return pa.array(texts, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())


def _plain_tokenizer(path: str, tokenizer):
    """A tokenizer of the same model for lower-case words of Latin letters,
    joined by spaces: what splits texts into such words and folds their case
    has nothing to do there. The given one if the file may treat them otherwise."""
    from tokenizers import Tokenizer, pre_tokenizers

    with open(path, encoding="utf-8") as file:
        steps = json.load(file)
    folds = (steps["normalizer"] or {}).get("normalizers", [])
    splits = (steps["pre_tokenizer"] or {}).get("pretokenizers", [])
    known = [n["type"] for n in folds] == ["NFC", "Replace", "Lowercase"] and folds[1]["pattern"] == {"Regex": "\\s+"}
    known = known and [n["type"] for n in splits] == ["Split", "ByteLevel"] and not splits[1]["add_prefix_space"] and not splits[1]["use_regex"]
    if not known or "|[\\p{L}]+|" not in splits[0]["pattern"].get("Regex", ""):
        return tokenizer
    plain = Tokenizer(tokenizer.model)
    plain.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    return plain


class _Grown:
    """An array that grows at its end."""

    def __init__(self, dtype):
        self.room, self.size = np.empty(1 << 12, dtype), 0

    def extend(self, more: np.ndarray) -> None:
        size = self.size + len(more)
        if size > len(self.room):
            room = np.empty(max(size, 3 * len(self.room) // 2), self.room.dtype)
            room[: self.size] = self.room[: self.size]
            self.room = room
        self.room[self.size : size] = more
        self.size = size


class WordEncoder:
    """A tokenizer whose tokens never cross ASCII white space, by words: each
    distinct word goes through the library once.

    Plain words are sent to it joined by spaces, many at a time: each of
    their pre-tokens gives one id that ends a word, so the ids fall apart into
    words again. All other words are encoded one by one, and so are all if
    the tokenizer marks no word ends."""

    def __init__(self, path: str, cache: int = WORD_CACHE):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has its core
        self.tokenizer, self.cache = Tokenizer.from_file(path), cache
        self.plain = _plain_tokenizer(path, self.tokenizer)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.ends_word[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self._reset()

    def _reset(self) -> None:
        # number 0, the empty word, stands for a text's end
        self.number: dict[bytes, int] = {}
        self.lengths, self.starts, self.flat, self.met = _Grown(np.int32), _Grown(np.int32), _Grown(np.uint32), _Grown(np.uint32)
        self._add([b""], np.ones(1, np.int32), np.zeros(1, np.uint32))

    def _forget(self) -> None:
        """Keep the words met in several batches, unless these are most of them."""
        often = np.flatnonzero(self.met.room[: self.met.size] > 1)
        often = often[often > 0]
        if len(often) > self.cache // 2:
            return self._reset()
        ids, lengths = self._ids(often)
        wanted = set(often.tolist())
        words = [w for w, i in self.number.items() if i in wanted]
        self._reset()
        self._add(words, lengths, ids)

    def _add(self, words: list[bytes], lengths: np.ndarray, ids: np.ndarray) -> None:
        first = len(self.number)
        self.number.update(zip(words, range(first, first + len(words))))
        self.starts.extend(self.flat.size + np.cumsum(lengths) - lengths)
        self.met.extend(np.zeros(len(words), np.uint32))
        self.lengths.extend(lengths)
        self.flat.extend(ids)

    def _learn_plain(self, words: pa.Array) -> None:
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], pc.utf8_lower(words)), " ")[0].as_py()
        ids = np.array(self.plain.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) == len(words) and ends[-1] == len(ids):
            self._add(words.view(pa.binary()).to_pylist(), np.diff(ends, prepend=0), ids)
        else:
            self._learn(words)

    def _learn(self, words: pa.Array) -> None:
        got = [e.ids for e in self.tokenizer.encode_batch_fast(words.to_pylist(), add_special_tokens=False)]
        lengths = np.fromiter(map(len, got), np.int64, len(got))
        self._add(words.view(pa.binary()).to_pylist(), lengths, np.fromiter(chain.from_iterable(got), np.uint32, int(lengths.sum())))

    def _unknown(self, words: pa.Array) -> pa.Array:
        words = pc.unique(words)
        number = self.number
        return words.filter(pa.array([w not in number for w in words.view(pa.binary()).to_pylist()], pa.bool_()))

    def _learn_all(self, new: pa.Array) -> None:
        """Ids of all words of ``new``, which are distinct and unknown."""
        body = pc.ascii_rtrim(new, characters=_MARKS)
        has_marks = pc.less(pc.binary_length(body), pc.binary_length(new))
        latin = pc.match_substring_regex(body, _PLAIN)
        plain, marked, others = pc.and_not(latin, has_marks), pc.and_(latin, has_marks), pc.invert(latin)
        bodies, whole = body.filter(marked), new.filter(marked)
        tails = _tails(whole, bodies)
        for learn, words in ((self._learn_plain, new.filter(plain)), (self._learn, new.filter(others))):
            if len(words):
                learn(words)
        if not len(whole):
            return
        for learn, words in ((self._learn_plain, self._unknown(bodies)), (self._learn, self._unknown(tails))):
            if len(words):
                learn(words)
        # ids of the word, then of the marks
        both = np.empty((len(whole), 2), np.int64)
        for k, part in enumerate((bodies, tails)):
            both[:, k] = list(map(self.number.__getitem__, part.view(pa.binary()).to_pylist()))
        ids, n = self._ids(both.ravel())
        self._add(whole.view(pa.binary()).to_pylist(), n.reshape(-1, 2).sum(axis=1), ids)

    def _ids(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words of these numbers, and how many each has."""
        n = self.lengths.room[which]
        before = np.cumsum(n, dtype=np.int64)
        total = int(before[-1]) if len(n) else 0
        before -= n
        at = np.arange(total, dtype=np.int64) + np.repeat(self.starts.room[which] - before, n)
        return self.flat.room[at], n

    def encode(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with ``end_id`` behind it, and their counts."""
        if len(self.number) > self.cache:
            self._forget()
        self.flat.room[0] = end_id
        # A-Z may be lowered first, unless special tokens or combining marks might see it
        lower = [t if b"<|" in t or b"\xcc" in t or b"\xcd" in t else t.translate(_LOWER) for t in texts]
        split = pc.ascii_split_whitespace(_utf8(lower))
        found = split.values.dictionary_encode()
        words = found.dictionary.view(pa.binary()).to_pylist()
        known = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(known < 0)
        if len(unknown):
            self._learn_all(found.dictionary.take(pa.array(unknown)))
            known[unknown] = [self.number[words[i]] for i in unknown.tolist()]
        self.met.room[known] += 1
        which = known[found.indices.to_numpy()]
        full = which > 0  # white space at a text's ends splits off an empty word
        upto = np.concatenate([[0], np.cumsum(full)])[split.offsets.to_numpy()]
        which = which[full]
        ended = np.zeros(len(which) + len(texts), np.int64)  # 0 at the texts' ends
        ended[np.arange(len(which)) + np.repeat(np.arange(len(texts)), np.diff(upto))] = which
        ids, n = self._ids(ended)
        return ids, np.diff(np.cumsum(n, dtype=np.int64)[upto[1:] + np.arange(len(texts))], prepend=0)


@cache
def _encoder(path: str) -> WordEncoder:
    """One for all tasks of a Python worker."""
    return WordEncoder(path)


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of texts to encode together: a word that several of them have is looked up once."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(), dtype=np.int64)
        at = 0
        while at < len(size):
            before = size[at - 1] if at else 0
            upto = max(at + 1, min(at + ENCODED_TEXTS, int(np.searchsorted(size, before + ENCODED_BYTES, "right"))))
            yield batch.slice(at, upto - at)
            at = upto


_SEGMENT = "part int, seg int, doc_ids array<long>, lengths array<int>, ids binary, counts binary"


def _segments(path: str, end_id: int):
    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seg = _encoder(path), TaskContext.get().partitionId(), 0
        docs: list = []
        counts: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held, total = 0, np.zeros(0, np.int64)
        types = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
        names = ["part", "seg", "doc_ids", "lengths", "ids", "counts"]

        def close() -> pa.RecordBatch:
            nonlocal held, seg, total
            coded = np.concatenate(ids).astype("<u4")
            total = _sum(total, np.bincount(coded))
            row = [part, seg, docs[:], np.concatenate(counts), coded.tobytes(), None]
            docs.clear(), counts.clear(), ids.clear()
            held, seg = 0, seg + 1
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

        for some in _together(batches):
            found, n = encoder.encode([t or b"" for t in some.column(1).to_pylist()], end_id)
            ends = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
            for at in range(0, len(n), SEGMENT_STEP):
                upto = min(at + SEGMENT_STEP, len(n))
                docs += some.column(0)[at:upto].to_pylist()
                counts.append(n[at:upto])
                ids.append(found[ends[at] : ends[upto]])
                held += len(ids[-1])
                if held >= SEGMENT_IDS:
                    yield close()
        if docs:
            yield close()
        if seg:  # the ids' counts, apart from the segments
            row = [part, -1, None, None, None, total.astype("<i8").tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

    return segments


def _sum(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of counts by id, one of which may end earlier."""
    size = max(len(a), len(b))
    return np.pad(a, (0, size - len(a))) + np.pad(b, (0, size - len(b)))


def _count_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        for counts in batch.column(0):
            total = _sum(total, np.frombuffer(counts.as_buffer(), "<i8"))
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["id", "n"])


def _encode(lengths: np.ndarray):
    codes = canonical_codes(lengths)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                ids = np.frombuffer(row.column(4)[0].as_buffer(), "<u4")
                data, marks = encode_ids(ids, lengths, codes)
                yield pa.RecordBatch.from_arrays(
                    [*row.columns[:4], pa.array([len(ids)]), pa.array([marks], pa.list_(pa.int64())), pa.array([data], pa.binary())],
                    names=["part", "seg", "doc_ids", "lengths", "n_ids", "checkpoints", "data"],
                )

    return encode


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Tokenize every whole text, append ``end_id`` to each document and write
    the ids to ``path/segments`` in ascending ``id_col`` order (nulls first,
    equal ids by the hash of their text), the code to ``path/codes``.

    ``tokenizer``: path of a tokenizers file whose pre-tokenizer drops white
    space. Null texts are empty. An empty table gives files without rows."""
    spark = docs.sparkSession
    ordered = (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("body"), F.xxhash64(text_col).alias("th"))
        .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "id", "th")
        .sortWithinPartitions("id", "th")
        .select("id", "body")
    )
    raw = stage(ordered.mapInArrow(_segments(tokenizer, end_id), _SEGMENT), "token-ids")
    # one row an id of the vocabulary
    counted = raw.where("seg < 0").select("counts").mapInArrow(_count_ids, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in counted), default=0) + 1, np.int64)
    for r in counted:
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts)
    spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths) if n], "id long, bits int").coalesce(1).write.parquet(f"{path}/codes")
    raw.where("seg >= 0").select("part", "seg", "doc_ids", "lengths", "ids").mapInArrow(
        _encode(lengths),
        "part int, seg int, doc_ids array<long>, lengths array<int>, n_ids long, checkpoints array<long>, data binary",
    ).write.parquet(f"{path}/segments")
    # positions of the segments, apart from their data
    spark.read.parquet(f"{path}/segments").select("part", "seg", "n_ids").write.parquet(f"{path}/index")
    drop_stage(raw)


def _decode(lengths: np.ndarray):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = decode_table(lengths)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                marks, n = row.column(5).flatten().to_numpy(), row.column(3).flatten().to_numpy()
                start = row.column(7)[0].as_py()
                ids = decode_ids(row.column(6)[0].as_py(), marks, row.column(4)[0].as_py(), decoder).astype("<u4")
                end = np.cumsum(n, dtype=np.int64)
                view = memoryview(ids).cast("B")
                crc = [zlib.crc32(view[4 * (e - k) : 4 * e]) for e, k in zip(end.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [row.column(2).flatten(), pa.array(start + end - n), pa.array(n.astype(np.int64)), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return decode


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row a document, from the files alone: ``doc_id``, ``start`` (ids of
    all documents before it), ``n_tokens`` and ``ids_crc32`` (of its ids as
    little-endian unsigned 32-bit integers)."""
    bits = {r["id"]: r["bits"] for r in spark.read.parquet(f"{path}/codes").collect()}  # one row an id
    lengths = np.zeros(max(bits, default=0) + 1, np.int64)
    for i, n in bits.items():
        lengths[i] = n
    files = spark.read.parquet(f"{path}/segments")
    index = spark.read.parquet(f"{path}/index")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = index.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row a writing task
    parts = parts.select("part", F.coalesce(F.sum("n").over(before.orderBy("part")), F.lit(0)).alias("base"))
    segs = index.select("part", "seg", F.coalesce(F.sum("n_ids").over(before.partitionBy("part").orderBy("seg")), F.lit(0)).alias("into"))
    starts = segs.join(parts, "part").select("part", "seg", (F.col("base") + F.col("into")).alias("first"))
    return (
        files.join(starts, ["part", "seg"])
        .select("part", "seg", "doc_ids", "lengths", "n_ids", "checkpoints", "data", "first")
        .mapInArrow(_decode(lengths), "doc_id long, start long, n_tokens long, ids_crc32 long")
    )


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = f"{checkpoint_dir(spark).rstrip('/')}/tripkiln-tokens/{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    write_token_files(docs, path, public_tokenizers.path(TOKENIZER))
    return read_token_files(spark, path)
