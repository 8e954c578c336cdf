"""The queries of the operators, one each, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quotelake.llm import sql
from quotelake.llm.alignment import op12_tokenizer_alignment
from quotelake.llm.decontamination import op4_decontamination
from quotelake.llm.fill_in_middle import op13_fill_in_middle
from quotelake.llm.html_text import op5_html_text
from quotelake.llm.jaccard_join import op2_jaccard_join
from quotelake.llm.licenses import op7_license_scan
from quotelake.llm.line_dedup import op11_line_dedup
from quotelake.llm.quality import op10_quality_rules
from quotelake.llm.sentencepieces import op6_best_path, op6_sentencepiece
from quotelake.llm.sharding import op9_kd_shards
from quotelake.llm.substring_dedup import op3_substring_dedup
from quotelake.llm.token_counts import op1_token_counts
from quotelake.llm.token_files import op8_token_files

QUERIES = (
    op1_token_counts,
    op2_jaccard_join,
    op3_substring_dedup,
    op4_decontamination,
    op5_html_text,
    op6_sentencepiece,
    op7_license_scan,
    op8_token_files,
    op9_kd_shards,
    op10_quality_rules,
    op11_line_dedup,
    op12_tokenizer_alignment,
    op13_fill_in_middle,
    op6_best_path,
)
ORACLES = {
    "op2_jaccard_join": sql.OP2,
    "op3_substring_dedup": sql.OP3,
    "op4_decontamination": sql.OP4,
    "op11_line_dedup": sql.OP11,
    "op13_fill_in_middle": sql.OP13,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Query name -> callable (spark, sf_dir) -> DataFrame."""
    return {query.__name__: query for query in QUERIES}


def oracle_sql() -> dict[str, str]:
    """Query name -> DuckDB SQL, where SQL can express the query."""
    return dict(ORACLES)
