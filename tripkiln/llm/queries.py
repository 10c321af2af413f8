"""The operators' queries over the whole test tables, and DuckDB oracles
where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripkiln.llm import ann, covertree, hard_negatives, line_dedup, mixing, packing, periods, pii, sharding, simhash, token_files, toxicity, url_filters

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": toxicity.query,
    "op2_url_filters": url_filters.query,
    "op3_mixing": mixing.query,
    "op4_line_dedup": line_dedup.query,
    "op5_packing": packing.query,
    "op6_sharding": sharding.query,
    "op7_ann": ann.query,
    "op8_simhash": simhash.query,
    "op9_cover_tree": covertree.query,
    "op10_token_files": token_files.query,
    "op11_pii": pii.query,
    "op12_hard_negatives": hard_negatives.query,
    "op13_periods": periods.query,
}

ORACLES: dict[str, str] = {
    "op2_url_filters": url_filters.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
}
