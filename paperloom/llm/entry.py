"""Queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from .bit_sliced import OP7_SQL, op7_bit_sliced_topk
from .decontamination import op5_decontamination
from .hard_negatives import OP13_SQL, op13_hard_negatives
from .html_text import op9_html_extraction
from .packing import op10_packing
from .phrases import OP12_SQL, op12_collocations
from .pii import op1_pii
from .quality import op6_quality_rules
from .sharding import op8_sharding
from .simhash import op2_simhash
from .token_counts import op11_token_counts
from .toxicity import op4_toxicity
from .url_filter import op3_url_filter


def queries() -> dict:
    return {
        "op1_pii": op1_pii,
        "op2_simhash": op2_simhash,
        "op3_url_filter": op3_url_filter,
        "op4_toxicity": op4_toxicity,
        "op5_decontamination": op5_decontamination,
        "op6_quality_rules": op6_quality_rules,
        "op7_bit_sliced_topk": op7_bit_sliced_topk,
        "op8_sharding": op8_sharding,
        "op9_html_extraction": op9_html_extraction,
        "op10_packing": op10_packing,
        "op11_token_counts": op11_token_counts,
        "op12_collocations": op12_collocations,
        "op13_hard_negatives": op13_hard_negatives,
    }


def oracle_sql() -> dict[str, str]:
    return {"op7_bit_sliced_topk": OP7_SQL, "op12_collocations": OP12_SQL, "op13_hard_negatives": OP13_SQL}
