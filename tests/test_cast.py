import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tripkiln.functions.columns import round_half_up
from tripkiln.operators.cleanse import cast_columns, drop_columns, drop_incomplete, rename_columns
from tripkiln.schema import CAST_SPEC, RAW_COLUMNS, CastRule, categorical_columns, numeric_columns, typed_schema

SPEC = (
    CastRule("n", "int"),
    CastRule("d", "double", 2),
    CastRule("s", "string"),
    CastRule("t", "timestamp"),
)


def test_cast_edge_values(spark):
    df = spark.createDataFrame(
        [
            ("12", "1.005", "x", "2021-07-04T09:08:07.5"),
            ("12.7", "2.5", None, "2021-13-01"),
            ("abc", "abc", "0012345", "2021-07-04 09:08:07"),
            ("", "", "+15551234567", ""),
            (None, None, None, None),
            ("1e12", "-0.125", "s", "2021-07-04"),
        ],
        "n string, d string, s string, t string",
    )
    out = cast_columns(df, SPEC)
    assert [f.dataType for f in out.schema.fields] == [
        T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()
    ]
    assert rows(out) == [
        (12, 1.01, "x", dt.datetime(2021, 7, 4, 9, 8, 7, 500000)),
        (12, 2.5, None, None),
        (None, None, "0012345", dt.datetime(2021, 7, 4, 9, 8, 7)),
        (None, None, "+15551234567", None),
        (None, None, None, None),
        (None, -0.13, "s", dt.datetime(2021, 7, 4, 0, 0)),
    ]


def test_cast_missing_column(spark):
    df = spark.createDataFrame([("1",)], "n string")
    with pytest.raises(ValueError):
        cast_columns(df, SPEC)
    assert cast_columns(df, SPEC, missing="skip").columns == ["n"]


def test_full_spec_shape():
    assert len(CAST_SPEC) == 45 and len(set(RAW_COLUMNS)) == 45
    schema = typed_schema()
    assert len(numeric_columns(schema)) == 29
    assert len(categorical_columns(schema)) == 13
    kinds = [r.kind for r in CAST_SPEC]
    assert kinds.count("int") == 10 and kinds.count("double") == 19 and kinds.count("timestamp") == 3


def test_column_classes_exclude_long_and_timestamp():
    schema = T.StructType(
        [
            T.StructField("a", T.IntegerType()),
            T.StructField("b", T.LongType()),
            T.StructField("c", T.DoubleType()),
            T.StructField("d", T.TimestampNTZType()),
            T.StructField("e", T.StringType()),
            T.StructField("f", T.DecimalType(10, 2)),
        ]
    )
    assert numeric_columns(schema) == ["a", "c"]
    assert categorical_columns(schema) == ["e"]


def test_drop_rename_required(spark):
    df = spark.createDataFrame(
        [(1.0, "a", "x"), (None, "b", "y"), (float("nan"), "c", "z")], "fare_amount double, keep string, gone string"
    )
    out = drop_incomplete(df)
    assert rows(out, "keep") == [("a",)]
    out = drop_columns(df, ("gone", "not_there"))
    assert out.columns == ["fare_amount", "keep"]
    out = rename_columns(df, {"keep": "kept", "absent": "x"})
    assert out.columns == ["fare_amount", "kept", "gone"]


def test_scale_conf():
    from tripkiln.session import scale_conf

    small = scale_conf(10 << 20)
    assert small["spark.sql.shuffle.partitions"] == "200"
    big = scale_conf(100 << 40)  # 100 TB
    assert big["spark.sql.shuffle.partitions"] == "409600"  # 256 MB a partition, no ceiling
    assert int(big["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) == 256 << 20


def test_row_id_and_compute_hook(spark):
    from pyspark.sql import functions as F

    from tripkiln.operators.cleanse import add_row_id, compute_columns

    df = spark.createDataFrame([(1, "a"), (2, "b"), (1, "a")], "k int, v string")
    stable = rows(add_row_id(df, ["k", "v"]), "id")
    assert stable[0] == stable[2] != stable[1]
    assert rows(add_row_id(df, ["k", "v"]), "id") == stable  # same rows, same ids
    unique = [r[0] for r in rows(add_row_id(df), "id")]
    assert len(set(unique)) == 3
    out = compute_columns(df, {"k2": F.col("k") * 2})
    assert [r[0] for r in rows(out, "k2")] == [2, 4, 2]
    assert compute_columns(df) is df


def test_rounding_is_that_of_the_decimal_text(spark):
    import random

    rng = random.Random(7)
    values = [0.0, -0.0, 0.5, -0.5, 1.005, 2.675, 1e300, -1e300, 5e-324, float("nan"), float("inf"), 0.285, 1.0000005, -3.4999999999]
    values += [rng.uniform(-10, 10) * 10 ** rng.randint(-8, 14) for _ in range(3000)]
    values += [rng.randint(-10**6, 10**6) / 2 ** rng.randint(0, 20) for _ in range(3000)]
    values += [round(rng.uniform(-1000, 1000), 3) // 0.01 * 0.01 + 0.005 for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    for digits in (0, 1, 2, 6):
        both = df.select("v", F.round("v", digits).alias("a"), round_half_up("v", digits).alias("b"))
        assert both.where("not (a <=> b)").collect() == []
    plan = cast_columns(df, (CastRule("v", "double", 2),))._jdf.queryExecution().optimizedPlan().toString()
    assert "FLOOR" in plan
