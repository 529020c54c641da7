"""The queries of this subpackage, and the SQL statements of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe_stream, byte_bpe, decontaminate, language_id, merkle, pii, quality_rules, simhash_dedup, token_count, token_ids, url_filter, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": language_id.op1_language_id,
    "op2_byte_bpe": byte_bpe.op2_byte_bpe,
    "op3_pii": pii.op3_pii,
    "op4_token_count": token_count.op4_token_count,
    "op5_simhash_dedup": simhash_dedup.op5_simhash_dedup,
    "op6_token_ids": token_ids.op6_token_ids,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_quality_rules": quality_rules.op8_quality_rules,
    "op9_warc": warc.op9_warc,
    "op10_url_filter": url_filter.op10_url_filter,
    "op11_bpe_stream": bpe_stream.op11_bpe_stream,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_whitening": whitening.op13_whitening,
}

ORACLE_SQL: dict[str, str] = {
    "op8_quality_rules": quality_rules.SQL,
    "op9_warc": warc.SQL,
    "op10_url_filter": url_filter.SQL,
    "op12_merkle_manifest": merkle.SQL,
}
