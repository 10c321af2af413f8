"""Every batch of both written tables is in the query's result."""

from tests.conftest import SF_SMALL
from tripkiln.plans.catalog import QUERIES


def test_all_batches_of_both_tables(spark):
    got = QUERIES["parquet_sink_tables"](spark, SF_SMALL).groupBy("written", "batch_no").count().collect()
    n = {(r["written"], r["batch_no"]): r["count"] for r in got}
    assert set(n) == {(t, b) for t in ("partitioned", "fanout") for b in range(5)}
    assert all(n["partitioned", b] == n["fanout", b] for b in range(5))
