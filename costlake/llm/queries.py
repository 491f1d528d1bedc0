"""The queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import bpe_report
from .fingerprints import fingerprint_report
from .langid import language_report
from .lattice import score
from .negatives import hard_negatives
from .packing import pack
from .pieces import piece_report
from .pii import pii_report
from .prefixtrie import conversation_trie
from .quality import judge
from .secrets import secrets_report
from .sharding import sharding_report
from .simhash import near_duplicate_report


def _documents(report: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: report(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scan": _documents(secrets_report),
        "op2_quality_divergence": _documents(judge),
        "op3_packing": _documents(pack),
        "op4_pii": _documents(pii_report),
        "op5_chunk_fingerprint": _documents(fingerprint_report),
        "op6_simhash": _documents(near_duplicate_report),
        "op7_sharding": _documents(sharding_report),
        "op8_language_compression": _documents(language_report),
        "op9_lattice_score": _documents(score),
        "op10_bpe_trie": _documents(bpe_report),
        "op11_conversation_trie": lambda spark, sf_dir: conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet")),
        "op12_sentencepiece": _documents(piece_report),
        "op13_hard_negatives": lambda spark, sf_dir: hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet")),
    }


def oracle_sql() -> dict[str, str]:
    return {}
