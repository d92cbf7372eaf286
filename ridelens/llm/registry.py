"""The subpackage's queries (spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline
from ridelens.llm.alignment import op13_alignment
from ridelens.llm.archives import OP9_SQL, op9_warc
from ridelens.llm.decontamination import op7_decontamination
from ridelens.llm.language import op1_language_id
from ridelens.llm.line_dedup import OP4_SQL, op4_line_dedup
from ridelens.llm.lm_score import op5_lm_score
from ridelens.llm.mixing import op6_mixing
from ridelens.llm.near_dup import op8_near_dup
from ridelens.llm.pii import op2_personal_data
from ridelens.llm.quality import op10_quality_rules
from ridelens.llm.spelling import OP12_SQL, op12_spelling_variants
from ridelens.llm.substring_dedup import OP3_SQL, op3_substring_dedup
from ridelens.llm.token_count import op11_token_counts

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_personal_data": op2_personal_data,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_lm_score": op5_lm_score,
    "op6_mixing": op6_mixing,
    "op7_decontamination": op7_decontamination,
    "op8_near_dup": op8_near_dup,
    "op9_warc": op9_warc,
    "op10_quality_rules": op10_quality_rules,
    "op11_token_counts": op11_token_counts,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_alignment": op13_alignment,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {
    "op3_substring_dedup": OP3_SQL,
    "op4_line_dedup": OP4_SQL,
    "op9_warc": OP9_SQL,
    "op12_spelling_variants": OP12_SQL,
}

if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
