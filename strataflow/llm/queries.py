"""The registered queries of this subpackage and, where SQL can express them, their oracles."""

from __future__ import annotations

import corpus_pipeline
from strataflow.llm.audit import OP12_SQL, op12_filter_audit
from strataflow.llm.jaccard import op13_jaccard_join
from strataflow.llm.language import op6_language_id
from strataflow.llm.mixing import op10_mixing, op10_sql
from strataflow.llm.packing import op7_best_fit_packing
from strataflow.llm.quality_rules import OP2_SQL, op2_quality_rules
from strataflow.llm.sharding import op3_sharding
from strataflow.llm.simhash import op9_simhash
from strataflow.llm.substring import op1_substring_dedup
from strataflow.llm.toxicity import op4_toxicity
from strataflow.llm.urlfilter import OP8_SQL, op8_url_filters
from strataflow.llm.vptree import op5_nearest_neighbours
from strataflow.llm.whitening import op11_whitening

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_substring_dedup": op1_substring_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_sharding": op3_sharding,
    "op4_toxicity": op4_toxicity,
    "op5_nearest_neighbours": op5_nearest_neighbours,
    "op6_language_id": op6_language_id,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_url_filters": op8_url_filters,
    "op9_simhash": op9_simhash,
    "op10_mixing": op10_mixing,
    "op11_whitening": op11_whitening,
    "op12_filter_audit": op12_filter_audit,
    "op13_jaccard_join": op13_jaccard_join,
}

ORACLES = {
    "op2_quality_rules": OP2_SQL, "op8_url_filters": OP8_SQL, "op10_mixing": op10_sql(), "op12_filter_audit": OP12_SQL}
