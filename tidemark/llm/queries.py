"""Registered queries of this subpackage, and the SQL that must agree where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import chat, factors, mixing, negatives, neighbours, ngrams, quality, resample, simhash, suffixes, tokens, warc, whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": suffixes.op1_suffix_dedup,
    "op2_simhash": simhash.op2_simhash,
    "op3_rlz_dedup": factors.op3_rlz_dedup,
    "op4_mixing": mixing.op4_mixing,
    "op5_quality_rules": quality.op5_quality_rules,
    "op6_bpe": tokens.op6_bpe,
    "op7_lm_scores": ngrams.op7_lm_scores,
    "op8_chat_format": chat.op8_chat_format,
    "op9_quality_classifier": resample.op9_quality_classifier,
    "op10_neighbours": neighbours.op10_neighbours,
    "op11_warc": warc.op11_warc,
    "op12_whitening": whiten.op12_whitening,
    "op13_hard_negatives": negatives.op13_hard_negatives,
}

ORACLE: dict[str, str] = {
    "op3_rlz_dedup": factors.ORACLE,
    "op8_chat_format": chat.ORACLE,
    "op11_warc": warc.ORACLE,
    "op13_hard_negatives": negatives.ORACLE,
}
