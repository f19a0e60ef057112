"""The registered queries of this package and their SQL counterparts."""

from __future__ import annotations

from galemark.llm.divergence import OP12_SQL, op12_source_divergence
from galemark.llm.collocations import OP13_SQL, op13_phrase_collocations
from galemark.llm.decontaminate import OP10_SQL, op10_benchmark_decontamination
from galemark.llm.importance import op1_importance_resampling
from galemark.llm.line_dedup import OP8_SQL, op8_line_dedup
from galemark.llm.near_dup import op2_minhash_near_dedup
from galemark.llm.packing import op7_best_fit_packing
from galemark.llm.permutation_index import op6_permutation_index
from galemark.llm.pii import op5_pii_boosting
from galemark.llm.secrets import op4_secret_linking
from galemark.llm.substring import op3_substring_dedup
from galemark.llm.toxicity import op11_toxicity_machine
from galemark.llm.warc import OP9_SQL, op9_warc_transactions

QUERIES = {
    f.__name__: f
    for f in (
        op1_importance_resampling, op2_minhash_near_dedup, op3_substring_dedup, op4_secret_linking,
        op5_pii_boosting, op6_permutation_index, op7_best_fit_packing, op8_line_dedup, op9_warc_transactions, op10_benchmark_decontamination,
        op11_toxicity_machine, op12_source_divergence, op13_phrase_collocations,
    )
}

ORACLES: dict[str, str] = {
    "op8_line_dedup": OP8_SQL,
    "op9_warc_transactions": OP9_SQL,
    "op10_benchmark_decontamination": OP10_SQL,
    "op12_source_divergence": OP12_SQL,
    "op13_phrase_collocations": OP13_SQL,
}
