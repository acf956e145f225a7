"""Queries and oracle SQL of the training-data operators, for ``__spark_entry__``."""

from __future__ import annotations

from .decontaminate import OP8_SQL, op8_benchmark_decontamination
from .html_extract import op1_html_extraction
from .jaccard_join import OP6_SQL, op6_ngram_jaccard_join
from .langid import op7_language_id
from .packing import op3_best_fit_packing
from .quality import op2_quality_classifier
from .substring_dedup import op4_suffix_array_dedup
from .token_counts import op9_token_counts
from .topk import OP10_SQL, op10_exact_topk
from .toxicity import op5_toxicity

QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_language_id": op7_language_id,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_token_counts": op9_token_counts,
    "op10_exact_topk": op10_exact_topk,
}
ORACLES = {"op6_ngram_jaccard_join": OP6_SQL, "op8_benchmark_decontamination": OP8_SQL, "op10_exact_topk": OP10_SQL}
