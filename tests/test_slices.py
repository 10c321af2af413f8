"""Large jobs in slices: the same rows, and shuffle files of one step at a time."""

import datetime as dt
import time
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF_SMALL, rows
from tests.oracle_compare import compare, duck
from tripkiln import session
from tripkiln.plans.gold import gold, gold_slices
from tripkiln.plans.runs import run_gold, run_silver
from tripkiln.sources import ledger, sinks
from tripkiln.sources.fixtures import kept_trips, raw_slices, raw_trips, trips
from tripkiln.sources.staging import stage, staged


@pytest.fixture
def sliced(monkeypatch):
    monkeypatch.setattr(session, "SLICE_BYTES", 70_000)  # some slices even of the smallest tables


def _shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in manager.localDirs() for f in Path(d.getPath()).glob("*/shuffle_*")}


def _nothing_left(spark, write):
    before = _shuffle_files(spark)
    write()
    until = time.time() + 10
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    return not _shuffle_files(spark) - before


def test_writes_drop_their_shuffle_files(spark, tmp_path):
    df = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).agg(F.count("*").alias("n"))

    def kept():
        with staged(df, "test") as there:
            assert len(there.collect()) == 10

    assert _nothing_left(spark, lambda: sinks.write_batch(df, f"{tmp_path}/t", "k"))
    assert _nothing_left(spark, lambda: sinks.write_csv(df, f"{tmp_path}/c"))
    assert _nothing_left(spark, lambda: sinks.write_parquet(df, f"{tmp_path}/p"))
    assert _nothing_left(spark, kept)
    assert spark.read.parquet(f"{tmp_path}/t").count() == 10


def test_slices_hold_every_trip_once(spark, sliced):
    parts = raw_slices(spark, SF_SMALL)
    assert len(parts) > 1
    whole = sorted(map(str, raw_trips(spark, SF_SMALL).collect()))
    assert sorted(str(r) for p in parts for r in p.collect()) == whole
    kept = kept_trips(spark, SF_SMALL)
    assert "Join" not in kept._jdf.queryExecution().optimizedPlan().toString()  # joined once, then read
    assert sorted(map(str, kept.collect())) == sorted(map(str, trips(spark, SF_SMALL).collect()))


@pytest.mark.parametrize("name", ["silver_clean", "gold_features", "csv_source", "gold_late_batch"])
def test_sliced_queries_match_their_oracles(spark, sliced, name):
    ok, n, _, _, detail = compare(spark, duck(SF_SMALL), name, E.queries()[name], E.oracle_sql()[name], SF_SMALL)
    assert ok and n, detail


def test_sliced_gold_counts_cover_all_rows(spark, sliced):
    silver = stage(E.queries()["silver_clean"](spark, SF_SMALL), "slices")
    parts = gold_slices(silver)
    assert len(parts) > 1
    assert sorted(str(r) for p in parts for r in p.collect()) == sorted(map(str, gold(silver).collect()))


@pytest.mark.parametrize("catalog", [False, True])
def test_a_retried_sliced_gold_run_replaces_its_rows(spark, sliced, tmp_path, monkeypatch, catalog):
    from tests.test_sources import _raw_line, _write_raw

    silver = str(tmp_path / "silver")
    target = "tk_sliced_gold" if catalog else str(tmp_path / "gold")
    read = lambda: spark.read.table(target) if catalog else spark.read.parquet(target)
    monkeypatch.setattr(session, "SLICE_BYTES", 4_000)
    real = ledger.commit
    for i, hour in enumerate((3, 1)):
        _write_raw(f"{tmp_path}/raw{i}/a.csv", [_raw_line(k) for k in range(6 + i)])
        run_silver(spark, f"{tmp_path}/raw{i}", silver, batch_time=dt.datetime(2024, 1, 1, hour))

        def fail(*a, **k):
            raise OSError("lost")

        monkeypatch.setattr(ledger, "commit", fail)
        with pytest.raises(OSError):
            run_gold(spark, silver, target)
        monkeypatch.setattr(ledger, "commit", real)
        assert run_gold(spark, silver, target).rows.count() == 6 + i
    assert read().count() == 13 and sorted(rows(read().groupBy("ingest_hour").count())) == [(1, 7), (3, 6)]
    if catalog:
        for t in (target, f"{target}__batches"):
            spark.sql(f"drop table {t}")


def test_consumed_drops_go(spark):
    runs = Path(urlparse(session.checkpoint_dir(spark)).path) / "tripkiln-runs"
    for name, drops in (("gold_late_batch", {"one", "two"}), ("stream_gold", {"landing"})):
        before = {f.name for f in runs.iterdir()} if runs.exists() else set()
        assert E.queries()[name](spark, SF_SMALL).count() > 0
        (mine,) = [f for f in runs.iterdir() if f.name not in before]
        left = {f.name for f in mine.iterdir()}
        assert {"silver", "gold"} <= left and not left & drops
