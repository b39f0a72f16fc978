"""The corpus pipeline: toxic documents, repeated lines, near copies and benchmark leaks go, the rest is packed.

Each stage takes what the one before has kept and returns the columns of
``documents``; the last returns the pieces of the packed sequences.  A null or
empty text, repeated rows and further columns pass as the stages' operators
define; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from patchloom.llm import decontamination, line_dedup, ngram_join, packing, toxicity
from patchloom.llm.queries import tokenizer_path
from patchloom.llm.session import cut_lineage

TOXICITY_THRESHOLD = 0.5


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the threshold; labels of documents that are gone are not used."""
    return toxicity.reject(docs, _table(spark, sf_dir, "labels"), TOXICITY_THRESHOLD)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of windows that the corpus has had before."""
    return line_dedup.remove_repeated_windows(docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least document of each group of near copies."""
    return ngram_join.keep_first(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontamination.remove_documents(docs, _table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents, placed in sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", keep_one_of_each_group),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

#: The classifier, the tokenizer and the components of links have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each stage's rows are written to the shared folder before the next."""
    docs = _table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut_lineage(docs)
    return docs
