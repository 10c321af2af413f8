import time
from collections import defaultdict
from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import functions as F

from tests.llm.conftest import SF
from tripkiln.llm import line_dedup as ld
from tripkiln.llm.common import stage
from tripkiln.session import checkpoint_dir


def _without_repeated_chunks(rows):
    """What is left when only repeated chunks of two or more lines that are
    not blank go (but for their first place)."""
    places = defaultdict(list)
    cut = {}
    for i, text in rows:
        cut[i] = ld.chunks(text.encode())
        for k, c in enumerate(cut[i]):
            if sum(bool(line.strip()) for line in c.split(b"\n")) > 1:
                places[c].append((i, k))
    first = {c: min(p) for c, p in places.items()}
    return {i: "\n".join(c.decode() for k, c in enumerate(cs) if c not in first or first[c] == (i, k)) for i, cs in cut.items()}


def test_query_removes_what_repeated_chunks_find(spark, docs):
    """Passages go from end to end (exactly so in ``test_passages``), and with
    them all that the content-defined chunks find: the words left are left there too."""
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    left = _without_repeated_chunks(rows)
    got = {r["doc_id"]: r for r in ld.query(spark, SF).collect()}
    assert set(got) == set(left)
    for i, r in got.items():
        there = iter(left[i].split())
        assert all(word in there for word in r["text"].split())
    assert any(r["n_chunks_removed"] for r in got.values()) and any(left[i] != t for i, t in rows)


def test_passages_go_wherever_they_stand(spark):
    passage = [f"shared line number {i} of the passage" for i in range(30)]
    rows = []
    for d in range(20):
        own = [f"document {d} line {i}" for i in range(d + 3)]
        rows.append((d, "\n".join(own[: d // 2] + passage + own[d // 2 :])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["text"].split("\n") for r in ld.drop_repeated_chunks(df).collect()}
    assert got[0] == rows[0][1].split("\n")
    for d in range(1, 20):  # all but the lines beside the passage's ends
        assert sum(x in passage for x in got[d]) <= 2 * ld.MAX_LINES
        assert [x for x in got[d] if x not in passage] == [x for x in rows[d][1].split("\n") if x not in passage]
    kept = sum(x in passage for d in range(1, 20) for x in got[d])
    assert kept < 0.5 * 19 * 30


def test_boundaries_survive_a_shift():
    lines = [f"line {i * i}".encode() for i in range(300)]
    a = set(ld.chunks(b"\n".join(lines)))
    b = set(ld.chunks(b"\n".join([b"new first line", *lines[:150], b"another", *lines[150:]])))
    assert len(a & b) > 0.9 * len(a)
    for text in (b"", b"x", b"x\ny", b"\n\n\n", b"\n".join(lines)):
        assert b"\n".join(ld.chunks(text)) == text


def test_edge_rows(spark, edge_docs, no_docs):
    df = edge_docs.unionByName(
        spark.createDataFrame([(50, "a\nb\n"), (51, "a\nb\n"), (None, "a\nb\n"), (52, "\n\n"), (53, "\n\n"), (50, "a\nb\n")], "doc_id long, text string"),
        allowMissingColumns=True,
    )
    got = ld.drop_repeated_chunks(df)
    assert got.columns == [*edge_docs.columns, "n_chunks_removed", "all_removed"] and got.count() == df.count()
    texts = {(r["doc_id"], r["text"], r["all_removed"]) for r in got.where("text is null or length(text) < 5").collect()}
    assert {(50, "a\nb\n", False), (51, "", True), (None, "", True), (52, "\n\n", False), (53, "\n\n", False), (2, None, False), (3, "", False)} <= texts
    assert got.where(F.col("doc_id") == 50).count() == 2  # repeated rows are one document and keep the chunk
    assert ld.drop_repeated_chunks(no_docs).count() == 0


def test_many_repeated_hashes_give_the_same_texts(spark, docs, edge_docs, monkeypatch):
    """Where the repeated hashes are too many to broadcast, their places are joined to the texts."""
    more = spark.createDataFrame([(50, "a\nb\n"), (51, "a\nb\n"), (None, "a\nb\n"), (50, "a\nb\n")], "doc_id long, text string")
    df = docs.select("doc_id", "text").unionByName(edge_docs.select("doc_id", "text")).unionByName(more)
    one = sorted(map(str, ld.drop_repeated_chunks(df).collect()))
    sent = []
    monkeypatch.setattr(ld, "_occurrences", lambda with_bytes, plain=ld._occurrences: sent.append(with_bytes) or plain(with_bytes))
    monkeypatch.setattr(ld, "BROADCAST_HASHES", -1)
    monkeypatch.setattr(ld, "BROADCAST_PLACES", -1)
    assert sorted(map(str, ld.drop_repeated_chunks(df).collect())) == one
    assert sent == [False]  # the bytes of all pairs are not shuffled


def test_steps_leave_no_files_behind(spark, docs):
    """What a step has written and shuffled goes when the next one no longer needs it."""
    before = {f.name for f in _staged(spark)}
    ld.drop_repeated_chunks(docs).count()
    left = {f.name.split("-")[0] for f in _staged(spark) if f.name not in before}
    assert left == {"removed"}


def test_a_staged_write_drops_its_shuffle_files(spark):
    jvm = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for d in jvm.localDirs() for f in Path(d.getPath()).glob("*/shuffle_*")}
    key, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", files()
    df = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).agg(F.count("*").alias("n"))
    staged = stage(df, "test")
    until = time.time() + 10
    while files() - before and time.time() < until:
        time.sleep(0.1)
    assert not files() - before
    assert staged.count() == df.count() == 10 and spark.conf.get(key) == "false"


def _staged(spark):
    folder = Path(urlparse(checkpoint_dir(spark)).path) / "tripkiln-stage"
    return list(folder.iterdir()) if folder.exists() else []
