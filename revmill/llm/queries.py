"""The registered queries of the subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from revmill.llm import (
    decontam,
    exact_dedup,
    merges,
    periods,
    pieces,
    scoring,
    sharding,
    simhash,
    substrings,
    surrogates,
    toxicity,
    variants,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_ftrl_toxicity": toxicity.op1_ftrl_toxicity,
    "op2_qgram_bands": decontam.op2_qgram_bands,
    "op3_pigeonhole_simhash": simhash.op3_pigeonhole_simhash,
    "op4_arc_to_warc": warc.op4_arc_to_warc,
    "op5_keyed_surrogates": surrogates.op5_keyed_surrogates,
    "op6_uniform_shards": sharding.op6_uniform_shards,
    "op7_extendible_hash": exact_dedup.op7_extendible_hash,
    "op8_level_doubling": substrings.op8_level_doubling,
    "op9_suffix_array_pieces": pieces.op9_suffix_array_pieces,
    "op10_cross_entropy_difference": scoring.op10_cross_entropy_difference,
    "op11_reduced_alphabet": variants.op11_reduced_alphabet,
    "op12_bounded_lookahead": merges.op12_bounded_lookahead,
    "op13_dyadic_squares": periods.op13_dyadic_squares,
}

ORACLES: dict[str, str] = {
    "op4_arc_to_warc": warc.SQL_OP4,
    "op7_extendible_hash": exact_dedup.SQL_OP7,
    "op8_level_doubling": substrings.SQL_OP8,
    "op11_reduced_alphabet": variants.SQL_OP11,
    "op13_dyadic_squares": periods.SQL_OP13,
}
