"""Readers of record files; each returns a lazy DataFrame."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchloom.operators import ranges
from patchloom.session import cut_lineage, free_name, prepare

MOST_SPLITS = 100_000


def json_lines(spark: SparkSession, path: str, schema: str, tolerant: bool = False) -> DataFrame:
    """Strict: one bad line fails the query.  Tolerant: bad lines stay as ``_corrupt_record`` for the caller to keep apart."""
    if not tolerant:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return spark.read.schema(f"{schema}, _corrupt_record string").option("mode", "PERMISSIVE").json(path)


def with_position(df: DataFrame, column: str = "_pos") -> DataFrame:
    """Adds the order of rows at ingest: by file path, then block of the file, then row of the block.

    It is a struct that compares in that order; readers do not keep rows' numbers
    in a file, but blocks are read front to back.  Call it on the reader's own
    table, before any shuffle.
    """
    meta = F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return df.select("*", meta.alias(column))


def with_row_number(df: DataFrame, column: str = "row") -> DataFrame:
    """Adds the row's number in its file, from 0, in two reads: one counts the rows of each split, one numbers them.

    Call it on the reader's own table, before any shuffle.  A split is read front
    to back, so a row's number is that of its split's first row and its place
    after that; only one row for each split is shuffled, and joined back, by
    broadcast if there are at most ``MOST_SPLITS``.
    """
    path, block, place, first, before = (free_name(df.columns, c) for c in ("path", "block", "place", "first", "before"))
    placed = df.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.file_block_start").alias(block), F.monotonically_increasing_id().alias(place))
    size = free_name([*placed.columns, first], "size")
    splits = placed.groupBy(path, block).agg(F.min(place).alias(first), F.count("*").alias(size))
    earlier = Window.partitionBy(path).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    starts = cut_lineage(splits.select(path, block, first, F.coalesce(F.sum(size).over(earlier), F.lit(0)).alias(before)))
    few = starts.limit(MOST_SPLITS + 1).count() <= MOST_SPLITS
    numbered = placed.join(F.broadcast(starts) if few else starts, [path, block])
    return numbered.select(*(c for c in df.columns if c != column), (F.col(before) + F.col(place) - F.col(first)).alias(column))


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows and the raw bad lines."""
    return df.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record"), df.filter(F.col("_corrupt_record").isNotNull()).select("_corrupt_record")


def json_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A whole file that is one object, or an array with a row for each element."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def keyed_json(spark: SparkSession, path: str, value_schema: str, key: str = "instance_id") -> DataFrame:
    """A whole file that is one object of records by key; the key becomes a column."""
    raw = spark.read.text(path, wholetext=True)
    parsed = raw.select(F.explode(F.from_json("value", f"map<string, struct<{value_schema}>>")).alias(key, "record"))
    return parsed.select(key, "record.*")


def _entries(spark: SparkSession, path: str, header: str, quoted: bool) -> DataFrame:
    """(path, key, row, value): the lines of each entry of files that begin an entry with a line of ``header``, whose groups are the key and the rest."""
    lines = with_row_number(spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path")), "row")
    key = F.regexp_extract("value", header, 1)
    begun = F.rlike("value", F.lit(header))
    lines = lines.withColumns({"key": F.when(begun, F.from_json(F.concat(F.lit("["), key, F.lit("]")), "array<string>")[0] if quoted else key), "first": F.when(begun, F.col("row")), "text": F.when(begun, F.regexp_extract("value", header, 2)).otherwise(F.col("value"))})
    carried = ranges.scan(lines, ["row"], {"key": ("last", "key"), "first": ("last", "first")}, ["path"]).filter("first IS NOT NULL")
    text = F.expr("listagg(text, '\n') WITHIN GROUP (ORDER BY row)")
    return carried.groupBy("path", "key", "first").agg(text.alias("value")).withColumnRenamed("first", "row")


def keyed_entries(spark: SparkSession, path: str, value_schema: str, key: str = "instance_id", indent: int = 2) -> DataFrame:
    """Records of files that are one object by key, written with a line for each entry, as ``json.dumps`` does with ``indent``.

    Such a file is read in splits: an entry's first line is known by its indent,
    and carried to the lines below by ranges of lines, so no task holds a file.
    Of a key that is repeated in a file the last entry counts.  A record that does
    not fit the schema fails the query.  ``keyed_json`` reads files of other shapes.
    """
    header = rf'^ {{{indent}}}("(?:[^"\\]|\\.)*")\s*:\s*(.*)$'
    entries = _entries(spark, path, header, True)
    last = entries.groupBy("path", "key").agg(F.max_by("value", "row").alias("value"))
    # The file's last entry is followed by the object's closing brace, the others by a comma.
    value = F.regexp_replace(F.regexp_replace("value", r"\n\}\s*$", ""), r",\s*$", "")
    parsed = last.select(F.col("key").alias(key), F.from_json(value, f"struct<{value_schema}>", {"mode": "FAILFAST"}).alias("record"))
    return parsed.select(key, "record.*")


def keyed_lists(spark: SparkSession, path: str, indent: int = 2, key: str = "status", item: str = "instance_id") -> DataFrame:
    """A row (key, pos, item) for each item of YAML files that map keys, at ``indent``, to lists of plain or quoted scalars.

    Files are read in splits, as by ``keyed_entries``.  Lines at a smaller indent
    name what holds the mapping.
    """
    plain = rf"""^ {{{indent}}}('(?:[^']|'')*'|"(?:[^"\\]|\\.)*"|[^\s'"#-][^#]*?)\s*:\s*()$"""
    lines = _entries(spark, path, plain, False)
    each = lines.select(_scalar(F.col("key")).alias(key), F.posexplode(F.regexp_extract_all("value", F.lit(r"(?m)^\s*- +(.*?)\s*$"), F.lit(1))).alias("pos", item))
    return each.withColumn(item, _scalar(F.col(item)))


def _scalar(text: Column) -> Column:
    """A YAML scalar without its quotes."""
    inner = F.substring(text, 2, 1 << 30)
    inner = F.left(inner, F.length(inner) - 1)
    double = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>")[0]
    return F.when(F.startswith(text, F.lit("'")), F.replace(inner, F.lit("''"), F.lit("'"))).when(F.startswith(text, F.lit('"')), double).otherwise(text)


def yaml_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(path, row): each YAML file as one record of the schema, by the YAML library's safe loader in Arrow batches; a file that is no YAML fails the query."""
    prepare(spark)

    @F.pandas_udf(T.StringType())
    def loaded(texts: pd.Series) -> pd.Series:
        import yaml

        return pd.Series([json.dumps(yaml.safe_load(t), default=str) for t in texts], dtype=object)

    whole = whole_text(spark, path)
    return whole.select("path", F.from_json(loaded("text"), schema, {"mode": "FAILFAST"}).alias("row"))


def whole_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def status_lists(spark: SparkSession, text: str) -> DataFrame:
    """(status, instance_ids) of a short YAML mapping of lists under 'instances_by_exit_status'."""
    try:
        import yaml

        data = yaml.safe_load(text) or {}
        rows = list((data.get("instances_by_exit_status") or {}).items())
    except ImportError:
        rows, at = [], None
        for line in text.splitlines():
            item = line.strip()
            if item.startswith("- ") and at is not None:
                at[1].append(item[2:].strip("'\""))
            elif item.endswith(":") and not item.startswith("instances_by_exit_status"):
                rows.append(at := (item[:-1].strip("'\""), []))
    return spark.createDataFrame([(k, list(v or [])) for k, v in rows], "status string, instance_ids array<string>")


def reports(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """report.json files under run_id/strategy/model/instance_id folders, with the folders as columns."""
    df = spark.read.schema(schema).option("multiLine", True).json(f"{root}/*/*/*/*/report.json").withColumn("__path", F.col("_metadata.file_path"))
    parts = F.split("__path", "/")
    for i, name in ((-5, "run_id"), (-4, "strategy"), (-3, "model"), (-2, "instance_id")):
        df = df.withColumn(name, F.element_at(parts, i))
    return df.drop("__path")
