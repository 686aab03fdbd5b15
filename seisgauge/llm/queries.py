"""The registered queries of this subpackage and, where it can be said, their SQL."""

from __future__ import annotations

from .dedup_queries import (
    op1_suffix_dedup,
    op4_decontamination,
    op5_substring_dedup,
    op6_minhash_dedup,
)
from .model_queries import op10_quality_classifier
from .output_queries import op2_token_files, op7_packing
from .rule_queries import OP3_SQL, OP9_SQL, op3_personal_data, op9_quality_rules
from .shipping import shipped
from .text_queries import (
    OP11_SQL,
    OP13_SQL,
    op11_source_divergence,
    op12_byte_bpe,
    op13_fill_in_middle,
)
from .url_queries import OP8_SQL, op8_url_filter

_PLAIN = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_token_files": op2_token_files,
    "op3_personal_data": op3_personal_data,
    "op4_decontamination": op4_decontamination,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_minhash_dedup": op6_minhash_dedup,
    "op7_packing": op7_packing,
    "op8_url_filter": op8_url_filter,
    "op9_quality_rules": op9_quality_rules,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_source_divergence": op11_source_divergence,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_fill_in_middle": op13_fill_in_middle,
}

QUERIES = {name: shipped(query) for name, query in _PLAIN.items()}

ORACLE_SQL = {
    "op3_personal_data": OP3_SQL,
    "op8_url_filter": OP8_SQL,
    "op9_quality_rules": OP9_SQL,
    "op11_source_divergence": OP11_SQL,
    "op13_fill_in_middle": OP13_SQL,
}
