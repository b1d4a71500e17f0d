"""Registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loanclean.llm.langid import op6_ppm_language
from loanclean.llm.licences import op11_licence_scan
from loanclean.llm.packing import op10_best_fit_packing
from loanclean.llm.periodic import op12_periodic_runs
from loanclean.llm.permindex import op8_permutation_index
from loanclean.llm.pii import op1_contextual_pii
from loanclean.llm.quality import op4_quality_gam
from loanclean.llm.repeats import op7_repeats
from loanclean.llm.simhash import op3_simhash_components
from loanclean.llm.tiling import op9_greedy_tiling
from loanclean.llm.tokenfile import op5_token_file
from loanclean.llm.toolcalls import OP2_SQL, op2_tool_calls
from loanclean.llm.whitening import op13_embedding_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_contextual_pii": op1_contextual_pii,
    "op2_tool_calls": op2_tool_calls,
    "op3_simhash_components": op3_simhash_components,
    "op4_quality_gam": op4_quality_gam,
    "op5_token_file": op5_token_file,
    "op6_ppm_language": op6_ppm_language,
    "op7_repeats": op7_repeats,
    "op8_permutation_index": op8_permutation_index,
    "op9_greedy_tiling": op9_greedy_tiling,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_licence_scan": op11_licence_scan,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_embedding_whitening": op13_embedding_whitening,
}
ORACLES: dict[str, str] = {"op2_tool_calls": OP2_SQL}
