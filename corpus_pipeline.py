"""The corpus pipeline: quality classifier, near-dedup, suffix dedup, secret scan, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows of docs, the result of the stage before; all but the last
return the columns of documents. Near-duplicates are texts whose sets of five-word shingles are similar to 0.8 or
more; one document of each group stays. Repeated passages of 50 words or more are cut out of texts wherever they
occur, and secrets are replaced by a mark. Documents emptied by that stay, as empty texts. Rows may be repeated or share
a doc_id: every stage takes each row by itself. Null and empty texts pass every stage (packing makes an end token of
them), and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from splatframe.llm import kneser_ney, minhash, packing, secrets, suffixes
from splatframe.llm.common import table, written

#: Repeated runs of so many bytes and words are cut: passages of over 50 words, the shortest of which take 3 bytes a
#: word, and not the lines and sentences that clean documents share.
REPEATED_BYTES, REPEATED_WORDS = 150, 50


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kneser_ney.kept_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.without_near_duplicates(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(docs, REPEATED_BYTES, REPEATED_WORDS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("suffix_dedup", suffix_dedup), ("secret_scan", secret_scan), ("pack", pack)]

#: Perplexities, similarity sketches and tokenizers are beyond SQL; tests/llm/test_pipeline.py has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
