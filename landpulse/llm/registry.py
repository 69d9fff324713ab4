"""The queries of this subpackage and their SQL, for ``__spark_entry__.py``."""

from __future__ import annotations

from .bpe import op10_bpe
from .decontamination import op7_decontamination
from .line_dedup import OP1_SQL, op1_line_dedup
from .quality_rules import OP5_SQL, op5_quality_rules
from .similarity_join import OP8_SQL, op8_jaccard_join
from .substring_dedup import OP4_SQL, op4_substring_dedup
from .suffix_array import OP6_SQL, op6_suffix_array
from .token_store import op3_token_store
from .toxicity import op2_toxicity
from .warc import OP9_SQL, op9_warc

QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_token_store": op3_token_store,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_suffix_array": op6_suffix_array,
    "op7_decontamination": op7_decontamination,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_warc": op9_warc,
    "op10_bpe": op10_bpe,
}

ORACLES = {
    "op1_line_dedup": OP1_SQL,
    "op4_substring_dedup": OP4_SQL,
    "op5_quality_rules": OP5_SQL,
    "op6_suffix_array": OP6_SQL,
    "op8_jaccard_join": OP8_SQL,
    "op9_warc": OP9_SQL,
}
