"""The registered queries of this package, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cellflux.llm import decontaminate, divergence, fim, licenses, minhash, mixing, packing, quality, repeats, secret_scan, tokens, toxicity, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": secret_scan.op1,
    "op2_licenses": licenses.op2,
    "op3_near_dedup": minhash.op3,
    "op4_mixing": mixing.op4,
    "op5_repeats": repeats.op5,
    "op6_url_rules": urls.op6,
    "op7_decontaminate": decontaminate.op7,
    "op8_quality": quality.op8,
    "op9_toxicity": toxicity.op9,
    "op10_token_shards": tokens.op10,
    "op11_packing": packing.op11,
    "op12_fill_in_middle": fim.op12,
    "op13_source_divergence": divergence.op13,
}

ORACLES: dict[str, str] = {
    "op4_mixing": mixing.ORACLE,
    "op6_url_rules": urls.ORACLE,
    "op7_decontaminate": decontaminate.ORACLE,
    "op8_quality": quality.ORACLE,
    "op13_source_divergence": divergence.ORACLE,
}
