"""Documents to packed training sequences, in five stages.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame``; its result
is written as Parquet and read again as the next stage's ``docs``. All but
the last return the columns of ``documents``; the last returns where every
piece of every document goes. ``sf_dir`` serves the toxicity labels only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkiln.llm import line_dedup, mixing, packing, simhash, toxicity
from tripkiln.llm.common import stage, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain finds toxic go."""
    chain = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, chain).where(~F.col("toxic")).select(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated multi-line chunks go, and documents of which nothing is left;
    ``n_chars`` follows the text."""
    out = line_dedup.drop_repeated_chunks(docs).where(~F.col("all_removed"))
    cut = F.when(F.col("n_chunks_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", cut).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.take(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document and its place in a bin."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("simhash_near_dedup", without_near_copies),
    ("mixing", mixed),
    ("best_fit_packing", packed),
]

#: The toxicity chain and SimHash have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
