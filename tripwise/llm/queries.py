"""The registered queries of this subpackage and their DuckDB counterparts."""

from __future__ import annotations

from tripwise.llm import (ann, collocations, decontaminate, importance, line_dedup, ngram_join, paragraph_dedup, quality, secret_scan,
                          sentencepiece_codec, token_counts, url_rules, warc)

QUERIES = {
    "op1_paragraph_dedup": paragraph_dedup.op1_paragraph_dedup,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_decontamination": decontaminate.op3_decontamination,
    "op4_warc": warc.op4_warc,
    "op5_quality": quality.op5_quality,
    "op6_block_search": ann.op6_block_search,
    "op7_ngram_join": ngram_join.op7_ngram_join,
    "op8_url_rules": url_rules.op8_url_rules,
    "op9_secret_scan": secret_scan.op9_secret_scan,
    "op10_sentencepiece": sentencepiece_codec.op10_sentencepiece,
    "op11_token_counts": token_counts.op11_token_counts,
    "op12_importance_resampling": importance.op12_importance_resampling,
    "op13_collocations": collocations.op13_collocations,
}

ORACLE_SQL = {
    "op2_line_dedup": line_dedup.ORACLE,
    "op3_decontamination": decontaminate.ORACLE,
    "op4_warc": warc.ORACLE,
    "op6_block_search": ann.ORACLE,
    "op8_url_rules": url_rules.ORACLE,
    "op9_secret_scan": secret_scan.ORACLE,
    "op12_importance_resampling": importance.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
