"""Bounded samples of labelled documents, and the held-out rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: At most so many labelled rows are used to fit a classifier.
SAMPLE_ROWS = 8000
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """True for the fold that no classifier learns from; a null id counts as 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(True))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``text`` and ``label`` of at most ``rows`` labelled documents outside the held-out fold.

    The rows are those of the least hashes of ``doc_id``, so a sample does not
    depend on partitions.  Rows without a label or an id are left out.
    """
    usable = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = usable.select("doc_id", F.col(label).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "label")
