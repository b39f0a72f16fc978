"""A table with one row per key that batches are merged into, by buckets of the key's hash.

A merge rewrites the buckets that the batch has keys of, into a folder of its
own, and then publishes a manifest, one small file that names the folder of each
bucket.  Readers follow the last manifest.  So untouched buckets keep their
files, a batch that fails midway is never seen, and a batch that a stream runs
again is known by its number in the manifest and left out.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchloom.operators import relational
from patchloom.session import cut_lineage, free_name

BUCKETS = 64


class Manifest(NamedTuple):
    """What a version of the table is: its key, buckets, schema, the folders of buckets that have rows, and each stream's last batch."""

    version: int
    key: str
    buckets: int
    schema: str
    folders: dict[str, str]
    batches: dict[str, int]


class KeyedTable:
    """The table at ``path``; all files are written and read by Spark."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: str | T.StructType, key: str, buckets: int = BUCKETS) -> KeyedTable:
        """An empty table; one that exists already is an error."""
        own = cls(spark, path)
        schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        if key not in schema.names:
            raise ValueError(f"no column {key}")
        own._publish(Manifest(0, key, buckets, schema.json(), {}, {}))
        return own

    def _publish(self, manifest: Manifest) -> None:
        """One file, moved into place when it is whole; a version that another writer has published is an error."""
        row = self.spark.createDataFrame([(json.dumps(manifest._asdict()),)], "value string")
        row.coalesce(1).write.mode("error").text(f"{self.path}/manifests/{manifest.version:09d}")

    def manifest(self, version: int | None = None) -> Manifest:
        """The last manifest, or that of a version."""
        at = "*" if version is None else f"{version:09d}"
        rows = self.spark.read.text(f"{self.path}/manifests/{at}").select(F.max_by("value", F.get_json_object("value", "$.version").cast("int"))).first()
        return Manifest(**json.loads(rows[0]))

    def exists(self) -> bool:
        try:
            return bool(self.manifest())
        except (AnalysisException, TypeError):
            return False

    def read(self, version: int | None = None) -> DataFrame:
        """The rows as of the last manifest, or of an earlier version."""
        own = self.manifest(version)
        return self._rows(own, list(own.folders.values()))

    def _rows(self, own: Manifest, folders: Sequence[str]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(own.schema))
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{f}" for f in folders))

    def _bucket(self, own: Manifest, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(own.buckets)).cast("int")

    def merge(self, batch: DataFrame, order: Sequence[str] = (), columns: Sequence[str] | None = None, stream: str | None = None, batch_id: int | None = None) -> int:
        """Sets ``columns`` (all, by default) of the keys that are there from the batch's last row of each, and adds the other keys whole.

        ``order`` tells the last row of a key; without it a key that is repeated
        in the batch is an error.  So is a null key.  Columns that the batch lacks
        stay, or are null in new rows; those that the table lacks are an error.
        Returns the version that has the batch: the one before where the stream's
        batch is there already, or where the batch is empty.
        """
        own = self.manifest()
        if stream is not None and batch_id is not None and batch_id <= own.batches.get(stream, -1):
            return own.version
        names = T.StructType.fromJson(json.loads(own.schema)).names
        if unknown := [c for c in batch.columns if c not in [*names, *order]]:
            raise ValueError(f"columns that the table lacks: {unknown}")
        key = own.key
        kept = [c for c in names if c in batch.columns]
        sure = F.raise_error(F.lit("a row without a key"))
        rows = batch.withColumn(key, F.coalesce(F.col(key), sure))
        if order:
            # Only the order's first row wins; ties are settled by the row itself.
            last = free_name(rows.columns, "last")
            rows = rows.groupBy(key).agg(F.max_by(F.struct(*kept), F.struct(*order, F.to_json(F.struct(*kept)))).alias(last)).select(f"{last}.*")
        else:
            one, n = (free_name(rows.columns, c) for c in ("one", "n"))
            rows = rows.groupBy(key).agg(F.first(F.struct(*kept)).alias(one), F.count("*").alias(n)).filter(F.when(F.col(n) > 1, F.raise_error(F.lit("a repeated key without an order"))).otherwise(F.lit(True)))
            rows = rows.select(f"{one}.*")
        bucket = free_name(names, "bucket")
        rows = cut_lineage(rows.withColumn(bucket, self._bucket(own, key)))
        touched = sorted(r[0] for r in rows.select(bucket).distinct().collect())
        if not touched:
            return own.version
        before = self._rows(own, [own.folders[str(b)] for b in touched if str(b) in own.folders])
        merged = relational.upsert(before, rows.drop(bucket), key, [c for c in columns or kept if c != key])
        folder = f"data/{own.version + 1:09d}-{uuid.uuid4().hex}"
        merged.select(*names).withColumn(bucket, self._bucket(own, key)).repartition(len(touched), bucket).write.partitionBy(bucket).parquet(f"{self.path}/{folder}")
        folders = own.folders | {str(b): f"{folder}/{bucket}={b}" for b in touched}
        batches = own.batches | ({stream: batch_id} if stream is not None and batch_id is not None else {})
        self._publish(own._replace(version=own.version + 1, folders=folders, batches=batches))
        return own.version + 1
