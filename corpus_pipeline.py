"""A corpus pipeline of five stages over the documents table.

Each stage takes (spark, docs, sf_dir), works on all rows it is given, and returns the columns of docs, but for the last, which
returns packed pieces. ``run`` writes each stage's result as Parquet in the shared folder and reads it for the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colscope.llm.common import Kept, release
from colscope.llm.decontam import drop_leaks
from colscope.llm.langid import UNDETERMINED, identify_languages, train
from colscope.llm.neardup import near_duplicates, without
from colscope.llm.packing import pack_documents
from colscope.llm.secretscan import redact_secrets

#: Least similarity of near-duplicates, over shingles of so many words.
SIMILAR, SHINGLE = 0.8, 5


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a language (null, empty, or without a letter) go."""
    longest = max(map(len, docs.columns))
    names = "lang_pred".ljust(longest + 1, "_"), "score".ljust(longest + 1, "_")  # unlike any column of docs
    found = identify_languages(docs, train(docs), names=names)
    return found.where(F.col(names[0]) != UNDETERMINED).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-duplicates: of each group the document with the least doc_id stays; rows of one doc_id stay together."""
    return without(docs, near_duplicates(docs, threshold=SIMILAR, width=SHINGLE).where(~F.col("kept")).select("doc_id").distinct())


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a benchmark item, copied or edited, go."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: reported spans are replaced in the texts; n_chars follows."""
    clean = redact_secrets(docs)
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*docs.columns) if "n_chars" in docs.columns else clean


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of what is left into sequences of 2048 tokens."""
    return pack_documents(docs, "word_bpe_49k.json", end_id=0, capacity=2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: Tokenizers, trained models and connected components are beyond SQL; the tests hold a brute-force version against run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of what all stages keep of the documents table.

    Rows with null or empty texts have no language and go in the first stage; every other null is kept as it is. Repeated rows
    stay together, texts of any length are handled whole, and further columns pass until the last stage. An empty table
    gives no rows.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        kept = Kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
        docs = kept.df
        if before:
            before.drop()
        before = kept
        release(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
