"""All queries of this subpackage."""

from quayside.llm import (  # noqa: F401
    bpe_chunks, filter_audit, fingerprints, hard_negatives, hmm_lm, html_extract, jaccard_join, language, packing,
    quality_model, quality_rules, secret_scan, toxicity,
)
from quayside.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
