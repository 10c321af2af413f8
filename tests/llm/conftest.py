import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977}" for i in range(40_000))

#: Null id, null / empty / blank / very long text, repeated rows, and columns named like working columns.
EDGE = [
    (1, "one two three four five six", "a"),
    (1, "one two three four five six", "a"),
    (2, None, "a"),
    (3, "", None),
    (4, " \t\n ", "b"),
    (None, "one two three four five seven", "b"),
    (5, LONG, "b"),
    (6, LONG + " end", None),
    (7, "Äpfel über ΣΑΣ 漢字 \u0301x", "c"),
]
CLASHING = ("size", "th", "n", "component", "toxic", "p_toxic", "rk", "idx", "bucket", "piece", "copies", "hash")


@pytest.fixture(scope="session")
def edge_docs(spark):
    df = spark.createDataFrame(EDGE, "doc_id long, text string, source string").repartition(3)
    return df.withColumns({c: F.lit(f"x-{c}") for c in CLASHING})


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
