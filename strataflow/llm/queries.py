"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontaminate, jaccard, langid, licences, lm, quality, sharding, token_counts, warc

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_quality": quality.documents_quality,
        "op2_language": langid.documents_languages,
        "op3_decontamination": decontaminate.documents_contamination,
        "op4_near_copies": jaccard.documents_near_copies,
        "op5_warc": warc.pages_archived,
        "op6_sharding": sharding.documents_shards,
        "op7_token_counts": token_counts.documents_token_counts,
        "op8_lm_scores": lm.documents_scores,
        "op9_licences": licences.documents_licences,
        "op10_byte_bpe": bpe.documents_tokens,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_decontamination": decontaminate.ORACLE_SQL, "op4_near_copies": jaccard.ORACLE_SQL, "op5_warc": warc.ORACLE_SQL}
