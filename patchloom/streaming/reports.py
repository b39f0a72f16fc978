"""A stream of reports: each instance once, merged into a table batch by batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from patchloom.sources.keyed_table import KeyedTable


def report_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with ``finished_at``, as files arrive."""
    return spark.readStream.schema(schema).json(path)


def once(reports: DataFrame, delay: str = "1 hour") -> DataFrame:
    """The first report of each run and instance within the delay; the state ends with the watermark."""
    return reports.withWatermark("finished_at", delay).dropDuplicatesWithinWatermark(["run_id", "instance_id"])


def pass_counts(reports: DataFrame, window: str = "10 minutes", delay: str = "1 hour") -> DataFrame:
    """Reports and passes per window of finishing time."""
    return reports.withWatermark("finished_at", delay).groupBy(F.window("finished_at", window)).agg(F.count("*").alias("reports"), F.count_if(F.col("func.pass") & F.col("sec.pass")).alias("passes"))


def write_table(reports: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends the stream to a partitioned table; a batch that runs again replaces its own files."""

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)

    return reports.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merge_table(rows: DataFrame, table: KeyedTable, checkpoint: str, name: str, order: Sequence[str] = (), columns: Sequence[str] | None = None) -> StreamingQuery:
    """Merges the stream into a keyed table, batch by batch; a batch that runs again, also after a restart, changes nothing."""

    def put(batch: DataFrame, batch_id: int) -> None:
        KeyedTable(batch.sparkSession, table.path).merge(batch, order, columns, name, batch_id)

    return rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
