"""Loads every module with queries of this subpackage."""

from ledgerloom.llm import (  # noqa: F401
    chat_format,
    exact_dedup,
    language_id,
    mixing,
    ngram_join,
    quality_classifier,
    quality_rules,
    secret_scan,
    sentencepiece_codec,
    simhash_dedup,
    spelling_variants,
    url_filter,
    vector_codes,
)
from ledgerloom.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
