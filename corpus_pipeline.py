"""From raw documents to packed training sequences: five stages over the documents table.

Every stage takes all that the one before kept; all but the last return the columns of documents, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.llm import language, quality
from marketframe.llm.arrow import Scratch, read_table
from marketframe.llm.decontaminate import decontaminated
from marketframe.llm.near_duplicates import deduplicated
from marketframe.llm.packing import pack_documents

#: A language is accepted if the model gives it at least this probability.
SURE = 0.5


def _accepted(docs: DataFrame, judge: Callable[[DataFrame], DataFrame], by: Column) -> DataFrame:
    """Rows of ``docs`` for which ``by`` holds after ``judge`` has added its columns.  While it does, the columns but
    the text have names of their own, so none of ``docs`` is read or replaced."""
    own = {c: c if c == "text" else f"_{i}" for i, c in enumerate(docs.columns)}
    judged = judge(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()]))
    return judged.where(by).select(*[F.col(n).alias(c) for c, n in own.items()])


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score, learnt from all labels, is at least 0.7; null and empty texts are scored too."""
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return _accepted(docs, lambda d: quality.score_quality(d, model), F.col("quality_score") >= quality.THRESHOLD)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the documents' own ``lang`` teaches; texts without a letter, and those
    that no language fits with probability 0.5, go."""
    model = language.train(docs)
    return _accepted(docs, lambda d: language.identify(d, model), (F.col("lang_pred") != "und") & (F.col("lang_score") >= SURE))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each class of near-duplicates."""
    return deduplicated(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, the passages of the benchmark cut out of their texts; n_chars follows the text."""
    clean = decontaminated(docs, read_table(spark, sf_dir, "benchmark"))
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of at most 2,048 ids of the 49k word vocabulary, each ended by id 1."""
    import public_tokenizers
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("quality", good_quality),
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written as Parquet and read again; the last one's pieces."""
    scratch, docs = Scratch(spark, "pipeline"), read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.store(stage(spark, docs, sf_dir), name)
        scratch.clear(docs)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}

#: The models of the stages can't be expressed in SQL; tests compare the stages with plain references.
ORACLE_SQL = None
ORACLE: dict[str, str] = {}
