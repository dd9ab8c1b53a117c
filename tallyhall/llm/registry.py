"""Queries of this folder and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .decision_list import op7_decision_list
from .fim import OP12_SQL, op12_seekable_fim
from .kmeans import OP13_SQL, op13_drift_tightened_kmeans
from .packing import op4_best_fit_packing
from .pii import op11_weak_supervision_pii
from .pitman_yor import op1_pitman_yor
from .prefix_free import op5_prefix_free_dedup
from .quality_svm import op6_nbsvm_quality
from .secrets import op8_secret_scan
from .simhash import op9_simhash_near_dedup
from .token_orc import op2_token_orc
from .toxicity import op10_chain_toxicity
from .winnowing import OP3_SQL, op3_winnowing

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_pitman_yor, op2_token_orc, op3_winnowing, op4_best_fit_packing, op5_prefix_free_dedup, op6_nbsvm_quality, op7_decision_list, op8_secret_scan, op9_simhash_near_dedup,
        op10_chain_toxicity, op11_weak_supervision_pii, op12_seekable_fim, op13_drift_tightened_kmeans)}
ORACLE: dict[str, str] = {"op3_winnowing": OP3_SQL, "op12_seekable_fim": OP12_SQL, "op13_drift_tightened_kmeans": OP13_SQL}
