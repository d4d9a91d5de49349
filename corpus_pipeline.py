"""A corpus pipeline from the operators of ``tessera.llm``.

``STAGES`` run in order, each on all that the one before kept; ``run``
writes every stage's result to the shared folder and reads it again, so a
stage that fails or loses executors repeats only its own work.

Defined cases, in every stage: a null text is the empty text, and stays null
in the rows that a stage keeps; texts of any length are read whole; rows with
a null id, and rows that share an id, are documents each; of equal or
near-equal texts the smallest id stays (a null id only where there is no
other), and of rows that are equal in id and text one; further columns,
whatever their names, pass through all stages but the last; an empty table
stays empty. ``encode`` returns a row for each row it gets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.byte_bpe import default_codec, round_trip
from tessera.llm.common import keep_decided, materialize, read_table, text_or_empty
from tessera.llm.decontaminate import keep_clean
from tessera.llm.exact_dedup import exact_dedup, normalized
from tessera.llm.near_dedup import near_duplicates
from tessera.llm.quality import document_stats, fit_quality, keep_quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects; fitted on these documents and ``labels``."""
    stats = materialize(document_stats(docs), "pipeline-stats")
    return keep_quality(docs, fit_quality(stats, read_table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of equal texts."""
    return keep_decided(docs, exact_dedup(docs), F.sha2(normalized().cast("binary"), 256))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates (five words, similarity of 0.8)."""
    return keep_decided(docs, near_duplicates(docs), F.sha2(text_or_empty().cast("binary"), 256))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold an item of ``benchmark``."""
    return keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, input_ids`` of every document."""
    return round_trip(docs, default_codec(), with_ids=True)


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near),
          ("decontaminate", decontaminate), ("encode", encode)]

# classifier, MinHash and tokenizer stages have no SQL form: tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
