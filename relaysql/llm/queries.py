"""The registered queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

import corpus_pipeline
from relaysql.llm import (decontaminate, fingerprints, hard_negatives, mixing, ngram_join, quality_rules, secret_scan,
                          spelling_variants, suffix_dedup, token_files, tool_calls, url_filter, warc_archive)

QUERIES = {
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op2_token_files": token_files.op2_token_files,
    "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_mixing": mixing.op5_mixing,
    "op6_tool_calls": tool_calls.op6_tool_calls,
    "op7_ngram_join": ngram_join.op7_ngram_join,
    "op8_url_filter": url_filter.op8_url_filter,
    "op9_warc_archive": warc_archive.op9_warc_archive,
    "op10_secret_scan": secret_scan.op10_secret_scan,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_fingerprints": fingerprints.op12_fingerprints,
    "op13_spelling_variants": spelling_variants.op13_spelling_variants,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op1_decontaminate": decontaminate.ORACLE,
    "op4_quality_rules": quality_rules.oracle(),
    "op6_tool_calls": tool_calls.ORACLE,
    "op8_url_filter": url_filter.ORACLE,
    "op9_warc_archive": warc_archive.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
}
