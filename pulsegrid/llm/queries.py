"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pulsegrid.llm.chat import OP9_SQL, op9_chat
from pulsegrid.llm.decontaminate import op10_decontamination
from pulsegrid.llm.knn import OP5_SQL, op5_top_k
from pulsegrid.llm.language_id import op2_language_id
from pulsegrid.llm.mixing import OP1_SQL, op1_mixing
from pulsegrid.llm.negatives import OP11_SQL, op11_hard_negatives
from pulsegrid.llm.quality import op4_quality
from pulsegrid.llm.secrets import op8_secrets
from pulsegrid.llm.simhash import op3_simhash
from pulsegrid.llm.substrings import OP7_SQL, op7_substrings
from pulsegrid.llm.toxicity import op13_toxicity
from pulsegrid.llm.url_filter import OP6_SQL, op6_url_filters
from pulsegrid.llm.whitening import op12_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_language_id": op2_language_id,
    "op3_simhash": op3_simhash,
    "op4_quality": op4_quality,
    "op5_top_k": op5_top_k,
    "op6_url_filters": op6_url_filters,
    "op7_substrings": op7_substrings,
    "op8_secrets": op8_secrets,
    "op9_chat": op9_chat,
    "op10_decontamination": op10_decontamination,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_whitening": op12_whitening,
    "op13_toxicity": op13_toxicity,
}

ORACLE: dict[str, str] = {
    "op1_mixing": OP1_SQL,
    "op5_top_k": OP5_SQL,
    "op6_url_filters": OP6_SQL,
    "op7_substrings": OP7_SQL,
    "op9_chat": OP9_SQL,
    "op11_hard_negatives": OP11_SQL,
}
