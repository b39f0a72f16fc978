"""Registered queries that write the given tables to the shared folder in a file format, and read them from there."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchloom.functions import render, templates
from patchloom.operators import ranges, relational
from patchloom.plans import evaluation
from patchloom.queries import _t, query
from patchloom.session import cut_lineage, shared_folder
from patchloom.sources import readers, writers


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def q_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of all kinds through JSON lines and back."""
    path = _folder(spark, "lines")
    writers.json_lines(_t(spark, sf_dir, "documents"), path)
    return readers.json_lines(spark, path, "doc_id bigint, text string, lang string, source string, n_chars bigint")


@query("SELECT o_orderkey % 10 = 3 AS bad, count(*) AS n FROM orders GROUP BY 1")
def q_tolerant_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which some are cut off are told from good ones."""
    path = _folder(spark, "cut")
    line = F.to_json(F.struct("o_orderkey", "o_custkey"))
    own = _t(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 10 == 3, F.left(line, F.lit(9))).otherwise(line).alias("text"))
    writers.text_lines(own, path)
    # Spark does not let a plan over files ask for the corrupt column alone.
    good, bad = readers.split_corrupt(cut_lineage(readers.json_lines(spark, path, "o_orderkey bigint, o_custkey bigint", tolerant=True)))
    return good.select(F.lit(False).alias("bad")).unionByName(bad.select(F.lit(True).alias("bad"))).groupBy("bad").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, p_name, p_size FROM part")
def q_keyed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as one indented object by key for each brand, read in splits by entry."""
    path = _folder(spark, "keyed")
    part = _t(spark, sf_dir, "part").select("p_brand", F.col("p_partkey").cast("string").alias("k"), F.struct("p_name", "p_size").alias("v"))
    whole = part.groupBy("p_brand").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("m")).select(render.indented_json(F.col("m")).alias("text"))
    # A file for each partition would hold several objects; each brand's goes to a folder of its own.
    whole.select(F.monotonically_increasing_id().alias("n"), F.col("text").alias("value")).repartition("n").write.partitionBy("n").text(path)
    got = readers.keyed_entries(spark, f"{path}/*", "p_name string, p_size int", "p_partkey")
    return got.select(F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_name", "p_size")


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderkey % 3 ORDER BY o_orderkey) - 1 AS row FROM orders")
def q_row_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in three files, numbered at ingest."""
    path = _folder(spark, "numbered")
    own = _t(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 3).alias("f"))
    own.repartition(3, "f").sortWithinPartitions("f", "o_orderkey").write.partitionBy("f").json(path)
    return readers.with_row_number(readers.json_lines(spark, f"{path}/*", "o_orderkey bigint"))


@query("SELECT DISTINCT event_type AS run_id, user_id::VARCHAR AS instance_id, count(*) AS n FROM events WHERE user_id % 3 = 1 GROUP BY ALL UNION ALL SELECT DISTINCT event_type, user_id::VARCHAR, 0 FROM events WHERE user_id % 3 <> 1 AND event_type <> 'error'")
def q_reports_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports by run: written, added to, and those of some runs replaced."""
    path = _folder(spark, "reports")
    own = _t(spark, sf_dir, "events").groupBy(F.col("event_type").alias("run_id"), F.col("user_id").cast("string").alias("instance_id")).agg(F.count("*").alias("n")).withColumns({"strategy": F.lit("generic"), "model": F.lit("m")})
    writers.reports(own.filter("run_id = 'error'").withColumn("n", F.lit(-1).cast("bigint")), path)
    writers.reports(own.filter("instance_id % 3 <> 1 AND run_id <> 'error'").withColumn("n", F.lit(0).cast("bigint")), path)
    # The runs of errors are done anew as a whole, the others are added to.
    writers.reports(own.filter("instance_id % 3 = 1 AND run_id = 'error'"), path, force=True)
    writers.reports(own.filter("instance_id % 3 = 1 AND run_id <> 'error'"), path)
    return spark.read.parquet(path).select("run_id", "instance_id", "n")


@query("""
SELECT p_brand, 'Brand ' || p_brand || ':' || chr(10) || string_agg('- ' || p_name || CASE WHEN p_size > 25 THEN ' (large)' ELSE '' END || chr(10), '' ORDER BY p_partkey) || count(*) || ' parts' AS page FROM part GROUP BY p_brand""")
def q_template_loop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page for each brand from a template with a loop and a condition."""
    template = "Brand {{ brand }}:\n{% for p in parts -%}\n- {{ p.p_name }}{{ \" (large)\" if p.large }}\n{% endfor %}{{ n }} parts"
    lists = _t(spark, sf_dir, "part").groupBy("p_brand").agg(F.array_sort(F.collect_list(F.struct("p_partkey", "p_name", (F.col("p_size") > 25).alias("large")))).alias("parts"), F.count("*").alias("n"))
    return lists.select("p_brand", templates.rendered(template, {"brand": F.col("p_brand"), "parts": F.col("parts"), "n": F.col("n")}).alias("page"))


@query("SELECT l_orderkey, l_partkey, l_linenumber, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_partkey, l_linenumber, l_shipdate) AS n, max(l_quantity) OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_partkey, l_linenumber, l_shipdate ROWS UNBOUNDED PRECEDING) AS top FROM lineitem")
def q_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and running maxima in three groups that hold all rows, by ranges."""
    own = _t(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_partkey", "l_linenumber", "l_shipdate", F.col("l_quantity").alias("top"), F.lit(1).cast("bigint").alias("n"))
    got = ranges.scan(own, ["l_orderkey", "l_partkey", "l_linenumber", "l_shipdate"], {"n": ("sum", "n"), "top": ("max", "top")}, ["l_returnflag"])
    return got.select("l_orderkey", "l_partkey", "l_linenumber", "n", "top")


BLOCK = "'diff --git a/{0} b/{0}' || chr(10) || '--- a/{0}' || chr(10) || '+++ b/{0}' || chr(10) || '@@ -1 +1 @@' || chr(10) || '-x' || chr(10) || '+' || {1} || chr(10)"
SQL_BLOCKS = [BLOCK.format("src/a.py", "p_partkey"), BLOCK.format("tests/test_a.py", "p_size")]


@query(f"""
WITH p AS (SELECT p_partkey, 't' || p_size AS task, CASE WHEN p_size % 3 = 0 THEN {BLOCK.format("src/a.py", "'t'")} ELSE {BLOCK.format("tests/test_a.py", "'t'")} END AS test,
  CASE WHEN p_size % 3 = 0 THEN {SQL_BLOCKS[1]} ELSE {SQL_BLOCKS[0]} END AS own FROM part WHERE p_size % 7 <> 0)
SELECT p_partkey, 'func' AS run_name, task || '|' || own AS patches FROM p UNION ALL SELECT p_partkey, 'sec', task || '|' || test || '|' || own FROM p""")
def q_run_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as predicted instances; the files that the test patch touches go from the prediction, finished ones are left out."""
    block = lambda path, line: F.concat(F.lit(f"diff --git a/{path} b/{path}\n--- a/{path}\n+++ b/{path}\n@@ -1 +1 @@\n-x\n+"), line, F.lit("\n"))
    part = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("instance_id"), "p_size", "p_partkey")
    text = lambda c: F.col(c).cast("string")
    test = F.when(F.col("p_size") % 3 == 0, block("src/a.py", F.lit("t"))).otherwise(block("tests/test_a.py", F.lit("t")))
    dataset = part.select("instance_id", F.concat(F.lit("t"), text("p_size")).alias("task_patch"), test.alias("test_patch"))
    whole = F.concat(block("src/a.py", text("p_partkey")), block("tests/test_a.py", text("p_size")))
    predictions = part.select("instance_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("_pos"), whole.alias("whole")).withColumn("model_patch", F.when(F.col("_pos") == 1, F.col("whole")).otherwise("old"))
    got = evaluation.run_requests(predictions.drop("whole"), dataset, finished=part.filter("p_size % 7 = 0").select("instance_id"))
    return got.select(F.col("instance_id").alias("p_partkey"), "run_name", F.array_join("patches", "|").alias("patches"))


@query("""
WITH s AS (SELECT p_brand, p_partkey, p_name, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n FROM part)
SELECT p_partkey, p_name FROM s WHERE n = 1""")
def q_one_of_each(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row of each brand that is last in a falling order."""
    own = _t(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_name", (-F.col("p_partkey")).alias("_pos"))
    return relational.one_of_each(own, ["p_brand"], "_pos").select("p_partkey", "p_name")
