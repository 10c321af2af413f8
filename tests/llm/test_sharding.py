import math
import zlib

import xxhash

from tests.llm.conftest import SF
from tripkiln.llm import sharding


def _uniform(key, shard):
    h = 42 if key is None else xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), 42)
    h = xxhash.xxh64_intdigest(shard.to_bytes(4, "little"), h)
    return ((h >> 11) + 0.5) * 2.0**-53


def _shard(key, weights):
    return max(range(len(weights)), key=lambda s: (weights[s] / -math.log(_uniform(key, s)), -s))


def test_query_matches_brute_force(spark, docs):
    got = sharding.query(spark, SF).collect()
    want = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    assert len(got) == len(want)
    for r in got:
        body = want[r["doc_id"]]
        assert (r["size"], r["text_crc32"], r["law"]) == (len(body) + 1, zlib.crc32(body), "key")
        assert r["shard"] == _shard(r["doc_id"], [1.0] * 16)
        assert r["grown_shard"] == _shard(r["doc_id"], [1.0] * 17)
        assert r["grown_shard"] in (r["shard"], 16)
    for s in range(16):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_weights_and_null_keys(spark):
    keys = spark.range(4000).withColumnRenamed("id", "k")
    weights = [1.0, 3.0, 2.0]
    got = sharding.assign_shards(keys, "k", weights).collect()
    assert all(r["shard"] == _shard(r["k"], weights) for r in got)
    share = [sum(r["shard"] == s for r in got) / len(got) for s in range(3)]
    assert all(abs(a - w / 6) < 0.03 for a, w in zip(share, weights))
    nulls = spark.createDataFrame([(None,), (None,)], "k long")
    assert {r["shard"] for r in sharding.assign_shards(nulls, "k", 5).collect()} == {_shard(None, [1.0] * 5)}


def test_slots_of_edge_rows(spark, edge_docs, no_docs):
    got = sharding.assign_slots(sharding.assign_shards(edge_docs, "doc_id", 2))
    assert got.columns == [*edge_docs.columns, "shard", "slot"] and got.count() == edge_docs.count()
    for s in (0, 1):
        slots = sorted(r["slot"] for r in got.where(got.shard == s).collect())
        assert slots == list(range(len(slots)))
    assert sharding.assign_slots(sharding.assign_shards(no_docs, "doc_id", 2)).count() == 0


def test_written_shards(spark, docs, tmp_path):
    sharding.write_shards(docs.select("doc_id"), str(tmp_path / "s"), "doc_id", 4)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert {(r["doc_id"], r["shard"]) for r in back.collect()} == {
        (r["doc_id"], _shard(r["doc_id"], [1.0] * 4)) for r in docs.select("doc_id").collect()
    }
