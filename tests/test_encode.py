"""Ordinal indices where many labels share a count and a beginning."""

from pyspark.sql import functions as F

from tripkiln.operators.encode import encode_ordinal, label_indices


def test_labels_of_one_count_and_beginning_are_spread(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20_000).select(F.format_string("label %05d", "id").alias("label"))
        got = label_indices(df, "label", "i")
        assert max(len(p) for p in got.rdd.glom().collect()) < 10_000
        assert got.where(F.col("i") != F.substring("__tk_label", 7, 5).cast("double")).count() == 0 and got.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_order_by_count_then_label_and_nulls_last(spark):
    values = ["b", "b", "a", "c", "c", None, "d", "c", ""]
    got = encode_ordinal(spark.createDataFrame([(v,) for v in values], "v string"), ("v",)).collect()
    want = {"c": 0.0, "b": 1.0, "": 2.0, "a": 3.0, "d": 4.0, None: 5.0}
    assert sorted(map(str, got)) == sorted(str(r) for r in got if want[r["v"]] == r["v_index"]) and len(got) == len(values)
