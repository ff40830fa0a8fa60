"""The subpackage's queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from splatframe.llm import audio, bpe, kneser_ney, lm, minhash, packing, secrets, sharding, suffixes, topk

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_audio_features": audio.query,
    "op2_exact_top_k": topk.query,
    "op3_stupid_backoff": lm.query,
    "op4_sharding": sharding.query,
    "op5_best_fit_packing": packing.query,
    "op6_suffix_array_dedup": suffixes.query,
    "op7_bpe_round_trip": bpe.query,
    "op8_quality_classifier": kneser_ney.query,
    "op9_minhash_near_dedup": minhash.query,
    "op10_secret_scan": secrets.query,
}

ORACLE_SQL: dict[str, str] = {"op2_exact_top_k": topk.ORACLE_SQL, "op3_stupid_backoff": lm.ORACLE_SQL, "op9_minhash_near_dedup": minhash.ORACLE_SQL}
