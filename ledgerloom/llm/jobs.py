"""Queries of this subpackage: name -> (builder, DuckDB SQL or None)."""

from __future__ import annotations

import corpus_pipeline

from . import (chat_format, embedding_dedup, jaccard_join, line_dedup, mixing, packing, periodic, pii, prefix_trie, quality, token_counts,
               token_files, toxicity)

QUERIES = {
    "op1_toxicity": (toxicity.query, None),
    "op2_quality_mcd": (quality.query, None),
    "op3_mixing": (mixing.query, mixing.ORACLE_SQL),
    "op4_token_counts": (token_counts.query, None),
    "op5_chat_format": (chat_format.query, chat_format.ORACLE_SQL),
    "op6_packing": (packing.query, None),
    "op7_token_files": (token_files.query, None),
    "op8_jaccard_join": (jaccard_join.query, None),
    "op9_embedding_dedup": (embedding_dedup.query, None),
    "op10_pii": (pii.query, None),
    "op11_line_dedup": (line_dedup.query, line_dedup.ORACLE_SQL),
    "op12_prefix_trie": (prefix_trie.query, prefix_trie.ORACLE_SQL),
    "op13_periodic_runs": (periodic.query, None),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
