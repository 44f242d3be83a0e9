"""The queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from .bpe import op2_bpe
from .decontaminate import OP5_SQL, op5_decontamination
from .language import op7_language
from .license_scan import op8_licenses
from .ngram_join import OP9_SQL, op9_jaccard_join
from .pii import op4_pii
from .quality import op6_quality
from .secret_scan import op3_secret_scans
from .topk import OP1_SQL, op1_topk_search
from .unigram import op10_token_counts


def queries():
    each = (op1_topk_search, op2_bpe, op3_secret_scans, op4_pii, op5_decontamination, op6_quality, op7_language, op8_licenses, op9_jaccard_join, op10_token_counts)
    return {f.__name__: f for f in each}


def oracle_sql() -> dict[str, str]:
    return {"op1_topk_search": OP1_SQL, "op5_decontamination": OP5_SQL, "op9_jaccard_join": OP9_SQL}
