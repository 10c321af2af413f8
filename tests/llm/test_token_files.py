import heapq
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import SF
from tripkiln.llm import token_files as tf

PATH = public_tokenizers.path(tf.TOKENIZER)


def _want(rows):
    t, start, out = Tokenizer.from_file(PATH), 0, []
    for i, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_matches_the_library(spark, docs):
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    assert sorted(tuple(r) for r in tf.query(spark, SF).collect()) == _want(rows)


def test_edge_rows(spark, edge_docs, no_docs, tmp_path):
    odd = spark.createDataFrame(
        [(20, "<|endoftext|> a<|startoftext|>b \x0b\x0c x y \x1c"), (21, "é ́ İ ŒΣ ﬁ"), (22, "\x00 '’s 12ab!?")],
        "doc_id long, text string",
    )
    df = edge_docs.select("doc_id", "text").union(odd)
    tf.write_token_files(df, str(tmp_path / "t"), PATH)
    got = sorted((tuple(r) for r in tf.read_token_files(spark, str(tmp_path / "t")).collect()), key=lambda r: r[1])
    rows = sorted(df.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    assert got == _want([tuple(r) for r in rows])  # nulls first; repeated rows are equal
    tf.write_token_files(no_docs, str(tmp_path / "none"), PATH)
    assert tf.read_token_files(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("n, limit", [(1, 18), (2, 18), (300, 18), (3000, 12), (40, 6)])
def test_code_is_optimal_or_limited(n, limit):
    rng = np.random.default_rng(n)
    counts = (1e6 / np.arange(1, n + 1) ** 2).astype(np.int64) + rng.integers(1, 3, n)
    lengths = tf.code_lengths(counts, limit)
    assert lengths.max() <= limit and (2.0 ** -lengths).sum() <= 1
    heap = [(int(c), i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    best, k = 0, n
    while len(heap) > 1:  # cost of the unlimited Huffman tree
        a, b = heapq.heappop(heap)[0], heapq.heappop(heap)[0]
        best += a + b
        heapq.heappush(heap, (a + b, k := k + 1))
    cost = int((lengths * counts).sum())
    assert cost >= best and (limit < 18 or n == 1 or cost == best)


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    counts = np.bincount(rng.zipf(1.4, 4000).clip(max=999), minlength=1000)
    lengths = tf.code_lengths(counts)
    ids = rng.choice(np.flatnonzero(lengths), n).astype(np.uint32)
    data, marks = tf.encode_ids(ids, lengths, tf.canonical_codes(lengths))
    assert len(marks) == -(-n // tf.BLOCK_IDS)
    decoder = tf.decode_table(lengths)
    if n:
        assert (tf.decode_ids(data, marks, n, decoder) == ids).all()
    if n > 2 * tf.BLOCK_IDS:  # from a checkpoint on, without the blocks before
        assert (tf.decode_ids(data, marks[2:], n - 2 * tf.BLOCK_IDS, decoder) == ids[2 * tf.BLOCK_IDS :]).all()


def test_word_cache_starts_anew():
    enc = tf.WordEncoder(PATH, cache=3)
    t = Tokenizer.from_file(PATH)
    for text in ("one two three four", "five six", "one seven two", ""):
        ids, n = enc.encode([text.encode()], 2)
        assert ids.tolist() == [*t.encode(text, add_special_tokens=False).ids, 2] and n.tolist() == [len(ids)]


def test_many_texts_are_encoded_together(spark, tmp_path, monkeypatch):
    """Words that several texts share are looked up once for them all; segments are cut as before."""
    texts = [f"shared words of text {i}" for i in range(3000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(3000)), pa.array([t.encode() for t in texts], pa.binary())], names=["id", "body"])
    assert [s.num_rows for s in tf._together([batch])] == [tf.ENCODED_TEXTS, 3000 - tf.ENCODED_TEXTS]
    monkeypatch.setattr(tf, "ENCODED_BYTES", 100)
    some = list(tf._together([batch]))
    assert sum(s.num_rows for s in some) == 3000 and all(s.num_rows < 6 for s in some)
    monkeypatch.undo()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tf.write_token_files(df.repartition(1), str(tmp_path / "t"), PATH)
    got = sorted((tuple(r) for r in tf.read_token_files(spark, str(tmp_path / "t")).collect()), key=lambda r: r[0])
    encode = tf.WordEncoder(PATH).encode
    ids = [encode([t.encode()], tf.END_ID)[0] for t in texts]
    starts = np.cumsum([0, *map(len, ids)]).tolist()
    assert got == [(i, starts[i], len(x), zlib.crc32(x.astype("<u4").tobytes())) for i, x in enumerate(ids)]
