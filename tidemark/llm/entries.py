"""Queries of the training-data operators and the SQL that some of them equal."""

from __future__ import annotations

from .arrow_files import op4
from .bin_completion import op11
from .chat import OP10_SQL, op10
from .collocations import OP13_SQL, op13
from .contamination import OP5_SQL, op5
from .html_text import op3
from .line_quality import op9
from .ngram_rules import op7
from .packing import op1
from .shards import op6
from .simhash import op8
from .substrings import op2
from .whitening import op12

QUERIES = {
    "op1_harmonic_packing": op1,
    "op2_sentence_span_dedup": op2,
    "op3_block_field_text": op3,
    "op4_arrow_token_files": op4,
    "op5_benchmark_hits": op5,
    "op6_weighted_hash_tree": op6,
    "op7_ngram_ratio_rules": op7,
    "op8_simhash_near_dedup": op8,
    "op9_line_field_quality": op9,
    "op10_prefix_target_chat": op10,
    "op11_bin_completion": op11,
    "op12_jacobi_davidson_whitening": op12,
    "op13_phrase_graph": op13,
}

ORACLE_SQL = {
    "op5_benchmark_hits": OP5_SQL,
    "op10_prefix_target_chat": OP10_SQL,
    "op13_phrase_graph": OP13_SQL,
}
