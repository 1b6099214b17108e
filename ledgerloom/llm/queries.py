"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpus_pipeline import run as pipeline

from .decontaminate import OP3_SQL, op3_decontaminate
from .exact_dedup import OP4_SQL, op4_exact_dedup
from .fim import OP13_SQL, op13_fill_in_middle
from .hard_negatives import OP11_SQL, op11_hard_negatives
from .html_extract import op6_html_extract
from .language_id import op8_language_id
from .line_dedup import op2_fuzzy_lines
from .mixing import op7_mixing
from .ngram_join import OP5_SQL, op5_ngram_join
from .quality import op10_quality
from .suffix_dedup import op12_suffix_dedup
from .token_output import op9_token_output
from .url_filter import OP1_SQL, op1_url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_fuzzy_lines": op2_fuzzy_lines,
    "op3_decontaminate": op3_decontaminate,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_ngram_join": op5_ngram_join,
    "op6_html_extract": op6_html_extract,
    "op7_mixing": op7_mixing,
    "op8_language_id": op8_language_id,
    "op9_token_output": op9_token_output,
    "op10_quality": op10_quality,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_fill_in_middle": op13_fill_in_middle,
    "pipeline": pipeline,
}

ORACLE_SQL: dict[str, str] = {
    "op1_url_filter": OP1_SQL,
    "op3_decontaminate": OP3_SQL,
    "op4_exact_dedup": OP4_SQL,
    "op5_ngram_join": OP5_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op13_fill_in_middle": OP13_SQL,
}
