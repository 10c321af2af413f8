import datetime as dt
import os

import pytest
from pyspark.errors import AnalysisException

from tests.conftest import rows
from tripkiln.plans.runs import run_gold, run_silver
from tripkiln.schema import RAW_COLUMNS
from tripkiln.sources import ledger
from tripkiln.sources.files import read_raw_csv
from tripkiln.sources.sinks import write_batch, write_csv, write_fanout
from tripkiln.sources.tables import (
    epoch_partition_floor,
    last_processed,
    last_value as last_value_of,
    newer_than,
    observe_rows,
    read_increment,
)


def _raw_line(i, fare="12.5", email=None, name="Ann Lee"):
    values = {c: "" for c in RAW_COLUMNS}
    values.update(
        VendorID="1", lpep_pickup_datetime=f"2021-07-04T09:{i:02d}:00.5", lpep_dropoff_datetime=f"2021-07-04T10:{i:02d}:00",
        request_datetime=f"2021-07-04T08:{i:02d}:00", passenger_count="2", trip_distance="3.456",
        fare_amount=fare, total_amount="20.04", tip_amount="2", PULocationID=str(i % 3), DOLocationID="7",
        passenger_email=email or f"p{i % 2}@x", driver_email="d@x", passenger_fullname=name,
        driver_fullname="Bob", passenger_phone_number="+15551234567", driver_phone_number="555",
        passenger_credit_card="4111111111111111", driver_credit_card="5500", passenger_sex="F",
        store_and_fwd_flag="N", passenger_age="31.9",
    )
    return ",".join(values[c] for c in RAW_COLUMNS)


def _write_raw(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(",".join(RAW_COLUMNS) + "\n")
        f.write("\n".join(lines) + "\n")


def test_read_raw_csv_and_empty_input(spark, tmp_path):
    _write_raw(str(tmp_path / "in" / "a.csv"), [_raw_line(1), _raw_line(2, fare="")])
    df = read_raw_csv(spark, str(tmp_path / "in"))
    assert df.count() == 2 and df.columns == list(RAW_COLUMNS)
    assert {f.dataType.simpleString() for f in df.schema.fields} == {"string"}
    (tmp_path / "empty").mkdir()
    empty = read_raw_csv(spark, str(tmp_path / "empty"))
    assert empty.count() == 0 and empty.columns == list(RAW_COLUMNS)
    # a path that is not there is an error, alone or beside others
    for path in (str(tmp_path / "mistyped"), str(tmp_path / "missing" / "*.csv"), [str(tmp_path / "in"), str(tmp_path / "no")]):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            read_raw_csv(spark, path)


def test_silver_and_gold_runs_are_incremental(spark, tmp_path):
    raw1, raw2 = str(tmp_path / "raw1"), str(tmp_path / "raw2")
    _write_raw(raw1 + "/a.csv", [_raw_line(i) for i in range(4)] + [_raw_line(9, fare="", name="Cher")])
    _write_raw(raw2 + "/b.csv", [_raw_line(i) for i in range(3)])
    silver_path, gold_path = str(tmp_path / "silver"), str(tmp_path / "gold")

    s1 = run_silver(spark, raw1, silver_path, batch_time=dt.datetime(2024, 1, 1, 0, 0, 0)).rows
    assert s1.count() == 5
    r = {row["passenger_first_name"]: row for row in s1.collect()}
    assert r["Cher"]["passenger_last_name"] is None
    assert r["Cher"]["fare_amount"] == 12.5  # mean of the other fares
    assert r["Ann"]["trip_distance"] == 3.46 and r["Ann"]["total_amount"] == 20.0
    assert r["Ann"]["passenger_phone_number"] == "+155***4567"
    assert r["Ann"]["passenger_credit_card"] == "*****" and r["Ann"]["driver_credit_card"] == "*****"
    assert r["Ann"]["passenger_age"] == 31
    assert "passenger_fullname" not in s1.columns and "pickup_datetime" in s1.columns

    g1 = run_gold(spark, silver_path, gold_path)
    assert g1.rows.count() == 5 and not g1.empty
    assert last_processed(spark, gold_path, "ingest_timestamp") == 1704067200
    assert last_processed(spark, gold_path, "ingest_datetime") == dt.datetime(2024, 1, 1)
    # nothing new: a second gold run adds nothing
    again = run_gold(spark, silver_path, gold_path)
    assert again.empty and again.rows.count() == 0 and again.rows.columns == g1.rows.columns

    run_silver(spark, raw2, silver_path, batch_time=dt.datetime(2024, 1, 2, 0, 0, 0))
    # the increment read prunes the older ingest_date partition
    inc = epoch_partition_floor(newer_than(spark.read.parquet(silver_path), "ingest_timestamp", 1704067200), 1704067200)
    plan = inc._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan and "2024-01-01" in plan
    assert inc.count() == 3
    g2 = run_gold(spark, silver_path, gold_path).rows
    assert g2.count() == 3
    # counts cover the increment only
    assert {r["driver_experience_level"] for r in g2.collect()} == {3}
    assert spark.read.parquet(gold_path).count() == 8


def test_a_drop_is_ingested_once(spark, tmp_path):
    raw, silver_path = str(tmp_path / "raw"), str(tmp_path / "silver")
    _write_raw(raw + "/a.csv", [_raw_line(i) for i in range(3)])
    assert run_silver(spark, raw, silver_path).rows.count() == 3
    again = run_silver(spark, raw, silver_path)
    assert again.empty and again.rows.count() == 0
    _write_raw(raw + "/b.csv", [_raw_line(9)])
    assert run_silver(spark, raw, silver_path).rows.count() == 1
    assert ledger.read_committed(spark, silver_path).count() == 4
    (tmp_path / "none").mkdir()
    nothing = run_silver(spark, str(tmp_path / "none"), str(tmp_path / "new"))
    assert nothing.empty and len(nothing.rows.columns) == 49
    with pytest.raises(AnalysisException):
        run_silver(spark, str(tmp_path / "mistyped"), silver_path)


def test_a_batch_committed_late_is_processed(spark, tmp_path):
    silver_path, gold_path = str(tmp_path / "silver"), str(tmp_path / "gold")
    for name, hour, n in (("x", 12, 5), ("y", 3, 3)):
        _write_raw(f"{tmp_path}/{name}/{name}.csv", [_raw_line(i) for i in range(n)])
        run_silver(spark, f"{tmp_path}/{name}", silver_path, batch_time=dt.datetime(2024, 1, 1, hour))
        assert run_gold(spark, silver_path, gold_path).rows.count() == n
    assert ledger.read_committed(spark, gold_path).count() == 8


def test_uncommitted_and_retried_batches(spark, tmp_path, monkeypatch):
    raw, silver_path, gold_path = str(tmp_path / "raw"), str(tmp_path / "silver"), str(tmp_path / "gold")
    _write_raw(raw + "/a.csv", [_raw_line(i) for i in range(3)])

    def fail(*a, **k):
        raise OSError("lost")

    real = ledger.commit
    monkeypatch.setattr(ledger, "commit", fail)
    with pytest.raises(OSError):
        run_silver(spark, raw, silver_path, batch_time=dt.datetime(2024, 1, 1, 1))
    assert ledger.read_committed(spark, silver_path).count() == 0  # rows without a commit are not seen
    monkeypatch.setattr(ledger, "commit", real)
    assert run_gold(spark, silver_path, gold_path).empty
    assert run_silver(spark, raw, silver_path, batch_time=dt.datetime(2024, 1, 1, 2)).rows.count() == 3
    assert ledger.read_committed(spark, silver_path).count() == 3
    monkeypatch.setattr(ledger, "commit", fail)
    with pytest.raises(OSError):
        run_gold(spark, silver_path, gold_path)
    monkeypatch.setattr(ledger, "commit", real)
    assert run_gold(spark, silver_path, gold_path).rows.count() == 3
    assert spark.read.parquet(gold_path).count() == 3  # the retry replaced its own rows


def test_runs_on_catalog_tables(spark, tmp_path):
    for name, n in (("x", 2), ("y", 3)):
        _write_raw(f"{tmp_path}/{name}/{name}.csv", [_raw_line(i) for i in range(n)])
        run_silver(spark, f"{tmp_path}/{name}", "tk_run_silver")
        assert run_gold(spark, "tk_run_silver", "tk_run_gold").rows.count() == n
        assert run_gold(spark, "tk_run_silver", "tk_run_gold").empty
    assert spark.read.table("tk_run_silver").count() == spark.read.table("tk_run_gold").count() == 5
    for t in ("tk_run_silver", "tk_run_gold", "tk_run_silver__batches", "tk_run_gold__batches"):
        spark.sql(f"drop table {t}")


def test_nothing_personal_stays_behind(spark, tmp_path):
    import __spark_entry__ as E
    from tests.conftest import SF_SMALL
    from urllib.parse import urlparse

    from tripkiln.session import checkpoint_dir

    base = urlparse(checkpoint_dir(spark)).path
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    staged_before = set(os.listdir(f"{base}/tripkiln-stage")) if os.path.isdir(f"{base}/tripkiln-stage") else set()
    for name in ("silver_clean", "silver_script_preset", "gold_features"):
        assert E.QUERIES[name](spark, SF_SMALL).count() > 0
        assert set(os.listdir(base)) <= before | {"tripkiln-stage"}
    spark.catalog.clearCache()
    raw, silver_path = str(tmp_path / "raw"), str(tmp_path / "silver")
    _write_raw(raw + "/a.csv", [_raw_line(i) for i in range(4)])
    seen = []
    import tripkiln.plans.runs as runs

    real = runs.write_silver

    def look(rows, *args):
        seen.append([tuple(r) for r in rows.select("passenger_credit_card", "driver_credit_card").distinct().collect()])
        real(rows, *args)

    runs.write_silver = look
    try:
        run_silver(spark, raw, silver_path)
    finally:
        runs.write_silver = real
    assert seen == [[("*****", "*****")]]  # the staged copy never held a card number
    now = set(os.listdir(f"{base}/tripkiln-stage")) if os.path.isdir(f"{base}/tripkiln-stage") else set()
    assert now <= staged_before


def test_cleanup_touches_own_folders_only(spark):
    from tripkiln.sources.staging import remove, stage, staged

    with staged(spark.range(3), "outer") as outer:
        other = stage(spark.range(5), "other")
        with staged(spark.range(4), "inner") as inner:
            assert inner.count() == 4
        assert outer.count() == 3 and other.count() == 5
    assert other.count() == 5
    remove(spark, other.inputFiles()[0].rsplit("/", 1)[0])


def test_increment_marks(spark, tmp_path):
    df = spark.createDataFrame([(0,), (1,), (2,)], "ts long")
    assert last_processed(spark, str(tmp_path / "nope"), "ts") is None
    assert newer_than(df, "ts", None).count() == 3
    assert newer_than(df, "ts", 0).count() == 2
    assert newer_than(df, "ts", 2).count() == 0
    src = str(tmp_path / "src")
    df.write.parquet(src)
    assert read_increment(spark, src, str(tmp_path / "target"), "ts").count() == 3
    plan = newer_than(spark.read.parquet(src), "ts", 1)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts,1)]" in plan


def test_observed_row_count(spark):
    df, obs = observe_rows(spark.range(0, 42))
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 42


def test_batch_write_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "a"), (1, "b")], "batch_id int, v string")
    write_batch(df, path, "batch_id")
    write_batch(df, path, "batch_id")  # a replay replaces, does not append
    write_batch(spark.createDataFrame([(2, "c")], "batch_id int, v string"), path, "batch_id")
    assert sorted(rows(spark.read.parquet(path), "v", "batch_id")) == [("a", 1), ("b", 1), ("c", 2)]


def test_fanout_and_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    sinks = [("parquet", str(tmp_path / "p"), "append"), ("csv", str(tmp_path / "c"), "overwrite")]
    group = "fanout"
    spark.sparkContext.setJobGroup(group, group)
    write_fanout(df.selectExpr("x", "upper(y) as y"), sinks)
    write_fanout(df.selectExpr("x", "upper(y) as y"), sinks[:1])
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).collect()[0]["y"] == "A"
    write_csv(df, str(tmp_path / "h"), header=True)
    assert spark.read.option("header", True).csv(str(tmp_path / "h")).columns == ["x", "y"]


def test_required_first_order(spark):
    from tripkiln.config import SilverConfig
    from tripkiln.plans.silver import silver
    from tripkiln.schema import CastRule

    spec = (CastRule("fare_amount", "double", 2), CastRule("n", "int"))
    df = spark.createDataFrame([("10", "1"), (None, "2"), ("20", None)], "fare_amount string, n string")
    default = silver(df, spec=spec, stamp=False)
    assert sorted(rows(default)) == [(10.0, 1), (15.0, 2), (20.0, 1)]
    strict = silver(df, SilverConfig(order="required_first"), spec=spec, stamp=False)
    # the row without a fare is dropped before the statistics are taken
    assert sorted(rows(strict)) == [(10.0, 1), (20.0, 1)]


def test_staged_copy_is_removed(spark):
    import os
    from urllib.parse import urlparse

    from tripkiln.session import checkpoint_dir
    from tripkiln.sources.staging import staged

    base = os.path.normpath(urlparse(checkpoint_dir(spark)).path)
    with staged(spark.range(0, 10), "probe") as df:
        assert df.count() == 10
        path = os.path.normpath(urlparse(df.inputFiles()[0]).path)
        folder = os.path.dirname(path)
        assert os.path.isdir(folder) and folder.startswith(base)
    assert not os.path.exists(folder)


def test_catalog_table_append_and_mark(spark):
    from tripkiln.sources.sinks import append_table
    from tripkiln.sources.tables import read_table, table_exists

    name = "tk_gold_probe"
    assert not table_exists(spark, name)
    assert last_processed(spark, name, "ts") is None
    append_table(spark.createDataFrame([(1, "a")], "ts long, v string"), name)
    append_table(spark.createDataFrame([(5, "b")], "ts long, v string"), name)
    assert table_exists(spark, name)
    assert read_table(spark, name).count() == 2
    assert last_processed(spark, name, "ts") == 5
    spark.sql(f"drop table {name}")


def test_silver_of_empty_drop_has_full_schema(spark, tmp_path):
    from tripkiln.plans.silver import silver

    (tmp_path / "nothing").mkdir()
    out = silver(read_raw_csv(spark, str(tmp_path / "nothing")))
    assert out.count() == 0
    assert len(out.columns) == 49
    assert {"passenger_first_name", "driver_last_name", "pickup_datetime", "ingest_datetime"} <= set(out.columns)
    assert not {"passenger_fullname", "driver_fullname", "lpep_pickup_datetime"} & set(out.columns)
    from tripkiln.plans.gold import gold

    g = gold(out)
    assert len(g.columns) == 64 and g.count() == 0
    assert {"passenger_loyalty", "driver_experience_level", "month", "route"} <= set(g.columns)


def test_malformed_lines_are_kept_with_their_text(spark, tmp_path):
    good = _raw_line(1)
    bad = good + ",extra,fields"
    _write_raw(str(tmp_path / "in" / "a.csv"), [good, bad])
    df = read_raw_csv(spark, str(tmp_path / "in"), keep_corrupt=True)
    got = {r["_corrupt_record"] is None: r for r in df.collect()}
    assert df.count() == 2
    assert got[True]["VendorID"] == "1"
    assert got[False]["_corrupt_record"] == bad


def test_silver_ignores_corrupt_record_column(spark, tmp_path):
    from tripkiln.plans.silver import silver

    _write_raw(str(tmp_path / "in" / "a.csv"), [_raw_line(1), _raw_line(2) + ",x"])
    out = silver(read_raw_csv(spark, str(tmp_path / "in"), keep_corrupt=True))
    assert "_corrupt_record" not in out.columns and out.count() == 2


def test_gold_run_leaves_no_staged_tables(spark, tmp_path):
    import os
    from urllib.parse import urlparse

    from tripkiln.session import checkpoint_dir

    base = os.path.join(urlparse(checkpoint_dir(spark)).path, "tripkiln-stage")
    raw, silver_path, gold_path = str(tmp_path / "raw"), str(tmp_path / "silver"), str(tmp_path / "gold")
    _write_raw(raw + "/a.csv", [_raw_line(i) for i in range(4)])
    run_silver(spark, raw, silver_path, batch_time=dt.datetime(2024, 3, 1))
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    assert run_gold(spark, silver_path, gold_path).rows.count() == 4
    after = set(os.listdir(base)) if os.path.isdir(base) else set()
    assert after <= before


def test_timestamp_mark_is_zone_free(spark):
    df = spark.createDataFrame(
        [(dt.datetime(1998, 12, 31, 20, 0),), (dt.datetime(1998, 12, 31, 23, 0),), (dt.datetime(1999, 1, 1, 1, 0),)],
        "ts timestamp_ntz",
    )
    key = "spark.sql.session.timeZone"
    old = spark.conf.get(key)
    spark.conf.set(key, "America/New_York")
    try:
        mark = last_value_of(df.where("ts < timestamp_ntz'1999-01-01 00:00:00'"), "ts")
        assert mark == dt.datetime(1998, 12, 31, 23, 0)
        assert rows(newer_than(df, "ts", mark), "ts") == [(dt.datetime(1999, 1, 1, 1, 0),)]
    finally:
        spark.conf.set(key, old)
