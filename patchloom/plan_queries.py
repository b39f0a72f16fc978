"""Further registered queries: whole plans and the operators that they are made of, each beside its DuckDB twin."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patchloom.functions import logs, patches, render, text
from patchloom.operators import curation, relational, scoring
from patchloom.plans import adaptive, collection, evaluation, feedback, masking, stages
from patchloom.queries import RUN_SQL, _t, query, run_logs
from patchloom.session import shared_folder
from patchloom.sources import writers
from patchloom.sources.keyed_table import KeyedTable
from patchloom.streaming import reports as streams
from patchloom.streaming import runs

PARSER = {"FAILED": r"(?P<n>\d+) failed", "PASSED": r"(\d+) passed", "ERROR": r"(\d+) error", "SKIPPED": ""}


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


@query(f"{RUN_SQL} SELECT user_id, side, CAST(failed AS INTEGER) AS failed, CAST(passed AS INTEGER) AS passed, CAST(errors AS INTEGER) AS errors, CAST(failed + errors AS INTEGER) AS failures FROM r")
def q_parsed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = logs.parsed_counts(F.col("logs"), PARSER)
    own = run_logs(spark, sf_dir).select("user_id", "side", counts.alias("c"))
    return own.select("user_id", "side", F.col("c.FAILED").alias("failed"), F.col("c.PASSED").alias("passed"), F.col("c.ERROR").alias("errors"), logs.failures(F.col("c")).alias("failures"))


@query(f"""{RUN_SQL}
SELECT user_id, side, CASE WHEN user_id % 7 <> 0 AND user_id % 7 <> 1 THEN CAST(failed AS INTEGER) ELSE -1 END AS failed, user_id % 7 IN (0, 1) AS faulty FROM r""")
def q_row_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    pattern = F.when(F.col("user_id") % 7 == 0, "(").when(F.col("user_id") % 7 == 1, r"\d+").otherwise(PARSER["FAILED"])
    got = run_logs(spark, sf_dir).select("user_id", "side", logs.parsed_by_rows(F.col("logs"), F.create_map(F.lit("FAILED"), pattern), strict=True).alias("p"))
    return got.select("user_id", "side", F.coalesce(F.try_element_at("p.counts", F.lit("FAILED")), F.lit(-1)).alias("failed"), F.col("p.fault").isNotNull().alias("faulty"))


def _evaluated(spark: SparkSession, sf_dir: str) -> evaluation.Evaluation:
    every = run_logs(spark, sf_dir).withColumn("instance_id", F.col("user_id").cast("string"))
    runs = every.select("instance_id", F.when(F.col("side") == 0, "func").otherwise("sec").alias("run_name"), "logs", "timed_out").filter("NOT (run_name = 'sec' AND instance_id % 10 = 3)")
    ids = every.select("user_id", "instance_id").distinct()
    pattern = F.when(F.col("user_id") % 10 == 2, "(").otherwise(PARSER["FAILED"])
    specs = ids.filter("user_id % 5 <> 4").select("instance_id", F.create_map(F.lit("FAILED"), pattern, F.lit("ERROR"), F.lit(PARSER["ERROR"])).alias("logs_parser"))
    dataset = ids.filter("user_id % 4 <> 3").select("instance_id", F.struct((F.col("user_id") % 3).alias("func"), (F.col("user_id") % 2).alias("sec")).alias("expected_failures"), F.array(F.lit("79"), F.lit("22")).alias("cwe_ids"))
    named = F.concat(F.lit("diff --git a/selected_cwes.json b/selected_cwes.json\n+++ b/selected_cwes.json\n@@ -0,0 +1 @@\n+{\"selected_cwes\": [\"79\", \""), (F.col("user_id") % 30).cast("string"), F.lit("\"]}"))
    predictions = ids.filter("user_id % 6 <> 5").select("instance_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("_pos"), F.concat(F.lit("m"), F.col("_pos").cast("string")).alias("model_name_or_path"), named.alias("model_patch"))
    finished = ids.filter("user_id % 9 = 1").select("instance_id", F.lit("old").alias("model"), *(F.struct(F.lit(True).alias("pass"), F.lit("completion").alias("status")).alias(n) for n in ("func", "sec")), F.struct(F.lit(1.0).alias("precision"), F.lit(1.0).alias("recall")).alias("cwes_selection"))
    return evaluation.evaluate(predictions, dataset, runs, specs, finished=finished, selection=True)


EVALUATED_SQL = f"""{RUN_SQL}, u AS (SELECT DISTINCT user_id FROM events), j AS (
  SELECT u.user_id, coalesce(f.status, 'model_patch_error') AS fs, coalesce(CASE WHEN u.user_id % 10 <> 3 THEN s.status END, 'model_patch_error') AS ss, coalesce(f.failed + f.errors, 0) AS ff, coalesce(s.failed + s.errors, 0) AS sf
  FROM u LEFT JOIN r f ON f.user_id = u.user_id AND f.side = 0 LEFT JOIN r s ON s.user_id = u.user_id AND s.side = 1 WHERE u.user_id % 4 <> 3 AND u.user_id % 6 <> 5
), fresh AS (SELECT *, CASE WHEN user_id % 5 = 4 THEN 'no specification' WHEN user_id % 10 = 2 AND (fs = 'completion' OR ss = 'completion') THEN 'pattern' END AS fault FROM j WHERE user_id % 9 <> 1
), reports AS (
  SELECT CAST(user_id AS VARCHAR) AS instance_id, 'm1' AS model, fs <> 'model_patch_error' AND ss <> 'model_patch_error' AND fs = 'completion' AND ff <= user_id % 3 AS func_pass,
         fs <> 'model_patch_error' AND ss = 'completion' AND sf <= user_id % 2 + CASE WHEN fs = 'completion' THEN least(user_id % 3, ff) ELSE 0 END AS sec_pass,
         CASE WHEN 'model_patch_error' IN (fs, ss) THEN 'model_patch_error' ELSE fs END AS func_status, CASE WHEN 'model_patch_error' IN (fs, ss) THEN 'model_patch_error' ELSE ss END AS sec_status,
         CASE WHEN user_id % 30 = 22 THEN 1::DOUBLE ELSE 0.5::DOUBLE END AS precision, CASE WHEN user_id % 30 = 22 THEN 1::DOUBLE ELSE 0.5::DOUBLE END AS recall
  FROM fresh WHERE fault IS NULL
  UNION ALL SELECT CAST(user_id AS VARCHAR), 'old', true, true, 'completion', 'completion', 1::DOUBLE, 1::DOUBLE FROM j WHERE user_id % 9 = 1
)"""


@query(f"{EVALUATED_SQL} SELECT * FROM reports")
def q_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evaluated(spark, sf_dir).reports.select("instance_id", "model", F.col("func.pass").alias("func_pass"), F.col("sec.pass").alias("sec_pass"), F.col("func.status").alias("func_status"), F.col("sec.status").alias("sec_status"), "cwes_selection.precision", "cwes_selection.recall")


@query(f"{EVALUATED_SQL} SELECT CAST(user_id AS VARCHAR) AS instance_id, 'internal_error' AS status, fault FROM fresh WHERE fault IS NOT NULL")
def q_evaluate_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evaluated(spark, sf_dir).skipped.select("instance_id", "status", F.when(F.startswith("fault", F.lit("pattern")), "pattern").otherwise(F.col("fault")).alias("fault"))


@query(f"""{EVALUATED_SQL}
SELECT instance_id, unnest(list_filter([CASE WHEN sec_status = 'model_patch_error' THEN 'model_patch_error' END, CASE WHEN sec_status <> 'model_patch_error' AND func_pass THEN 'correct' END,
  CASE WHEN sec_status <> 'model_patch_error' AND func_pass AND sec_pass THEN 'correct_secure' END], lambda x: x IS NOT NULL)) AS detail FROM reports""")
def q_eval_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.eval_details(_evaluated(spark, sf_dir).reports)


SETUP_SQL = f"""{RUN_SQL}, n AS (SELECT user_id, event_id % 2 AS side, count_if(event_type IN ('error', 'signup')) AS symbols FROM events GROUP BY 1, 2),
w AS (SELECT r.user_id, r.side, r.status = 'completion' AS done, r.failed + r.errors AS f, n.symbols FROM r JOIN n ON r.user_id = n.user_id AND r.side = n.side)"""


@query(f"""{SETUP_SQL}
SELECT CAST(t.user_id AS VARCHAR) AS instance_id, NOT (t.done AND t.symbols > b.symbols) AND (NOT t.done OR (t.f > b.f AND b.f < t.f)) AND NOT b.done AS accepted,
       CAST(b.f AS INTEGER) AS expected_func, CAST(CASE WHEN t.done THEN t.f - b.f ELSE -1 END AS INTEGER) AS num_sec_tests FROM w t JOIN w b ON t.user_id = b.user_id AND t.side = 1 AND b.side = 0""")
def q_validated_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The odd events' log is the run with security tests, the even events' stands for the other four."""
    every = run_logs(spark, sf_dir).withColumn("instance_id", F.col("user_id").cast("string"))
    names = F.when(F.col("side") == 1, F.array(F.lit("sec_test"))).otherwise(F.array(*(F.lit(n) for n in ("base", "rollback", "sec_patch", "task"))))
    runs = every.withColumn("run_name", F.explode(names)).select("instance_id", "run_name", "logs", "timed_out")
    specs = every.select("instance_id").distinct().withColumn("logs_parser", F.create_map(*(F.lit(x) for s in ("FAILED", "ERROR") for x in (s, PARSER[s]))))
    got = evaluation.validated_tasks(runs, specs)
    return got.select("instance_id", "accepted", F.col("expected_failures.func").alias("expected_func"), "num_sec_tests")


@query("""
WITH e AS (SELECT user_id, event_id % 2 AS side, event_id, CASE event_type WHEN 'view' THEN concat(event_id % 5, ' failed') WHEN 'click' THEN concat(event_id % 7, ' passed') WHEN 'error' THEN 'TypeError: bad' WHEN 'signup' THEN 'NameError: name'
  ELSE CASE WHEN event_id % 11 = 0 THEN 'INTERNALERROR> x' ELSE concat(event_id % 3, ' error') END END AS line FROM events),
had AS (SELECT user_id, line, count(*) AS n FROM e WHERE side = 0 GROUP BY 1, 2), s AS (SELECT user_id, line, event_id, row_number() OVER (PARTITION BY user_id, line ORDER BY event_id) AS nth FROM e WHERE side = 1)
SELECT CAST(s.user_id AS VARCHAR) AS instance_id, string_agg(s.line, '|' ORDER BY event_id) AS lines FROM s LEFT JOIN had h ON h.user_id = s.user_id AND h.line = s.line WHERE nth > coalesce(n, 0) AND s.user_id % 3 = 0 GROUP BY 1""")
def q_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = run_logs(spark, sf_dir).withColumn("instance_id", F.col("user_id").cast("string"))
    asked = every.groupBy("instance_id").agg(F.max("user_id").alias("u")).select("instance_id", F.struct((F.col("u") % 3 == 0).alias("pass")).alias("func"), F.struct(F.lit(False).alias("pass")).alias("sec"))
    runs = every.select("instance_id", F.when(F.col("side") == 0, "func").otherwise("sec").alias("run_name"), "logs")
    got = feedback.security_feedback(asked, runs)
    return got.select("instance_id", F.array_join("lines", "|").alias("lines")).filter("lines <> ''")


def _python_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source per part before and after a change of its first test, its helper, or a line added to its last test."""
    kind = F.col("p_partkey") % 4
    head, helper, last = "def test_a():\n    x = 1\n", "def helper():\n    y = 2\n", "def test_b():\n    z = 3\n"
    before = F.when(F.col("p_partkey") % 10 == 9, "def (").otherwise(head + helper + last)
    after = F.when(kind == 0, head.replace("1", "9") + helper + last).when(kind == 1, head + helper.replace("2", "9") + last).when(kind == 2, head + helper + last + "    w = 4\n").otherwise(helper + last)
    hunk = F.when(kind == 0, "@@ -2 +2 @@\n-    x = 1\n+    x = 9").when(kind == 1, "@@ -4 +4 @@\n-    y = 2\n+    y = 9").when(kind == 2, "@@ -6 +6,2 @@\n     z = 3\n+    w = 4").otherwise("@@ -1,2 +0,0 @@\n-def test_a():\n-    x = 1")
    # A scan of the keys has few splits for all the text that is made of them.
    keys = _t(spark, sf_dir, "part").select("p_partkey").repartition(2 * spark.sparkContext.defaultParallelism, "p_partkey")
    return keys.select("p_partkey", hunk.alias("hunks"), before.alias("before"), after.alias("after"))


NL = "' || chr(10) || '"
HEAD_SQL, HELPER_SQL, LAST_SQL = (f"'def {n}():{NL}    {v}{NL}'" for n, v in (("test_a", "x = 1"), ("helper", "y = 2"), ("test_b", "z = 3")))
MASKED_SQL = f"CASE WHEN p_partkey % 4 IN (0, 3) THEN {HELPER_SQL} || {LAST_SQL} WHEN p_partkey % 4 = 1 THEN {HEAD_SQL} || {HELPER_SQL} || {LAST_SQL} ELSE {HEAD_SQL} || {HELPER_SQL} END"


@query(f"SELECT p_partkey, CASE WHEN p_partkey % 10 <> 9 THEN {MASKED_SQL} END AS masked, p_partkey % 10 = 9 AS faulty, CASE WHEN p_partkey % 10 <> 9 THEN p_partkey % 4 <> 1 END AS has_mask FROM part")
def q_masked_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = masking.masked_tests(_python_files(spark, sf_dir))
    return got.select("p_partkey", "masked", F.col("fault").isNotNull().alias("faulty"), (F.col("mask") != "").alias("has_mask"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 4 IN (0, 1) THEN 5 WHEN p_partkey % 4 = 2 THEN 6 ELSE 4 END AS lines FROM part WHERE p_partkey % 10 <> 9")
def q_line_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _python_files(spark, sf_dir).filter("p_partkey % 10 <> 9")
    return patches.line_map(files, "hunks", "before", "after").groupBy("p_partkey").agg(F.count("*").cast("int").alias("lines"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS instance_id, CASE WHEN p_partkey % 10 = 9 THEN 'faulty' WHEN p_partkey % 6 = 5 THEN 'no source' ELSE 'good' END AS kind, CAST(CASE WHEN p_partkey % 10 = 9 OR p_partkey % 6 = 5 THEN 0 WHEN p_partkey % 4 IN (0, 2) THEN 1 WHEN p_partkey % 4 = 1 THEN 1 ELSE 0 END AS INTEGER) AS files FROM part WHERE p_partkey % 10 <> 9 OR p_partkey % 6 <> 5")
def q_expanded_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _python_files(spark, sf_dir).filter("p_partkey % 10 <> 9 OR p_partkey % 6 <> 5").withColumn("instance_id", F.col("p_partkey").cast("string"))
    records = files.select("instance_id", patches.merged_patch(F.array(F.struct(F.lit("tests/test_x.py").alias("path"), F.col("hunks").alias("hunk")))).alias("test_patch"))
    sources = files.filter("p_partkey % 6 <> 5").select("instance_id", F.lit("tests/test_x.py").alias("path"), "before", "after")
    got = masking.restored(records, sources)
    kind = F.when(F.col("fault").isNull(), "good").when(F.col("fault") == "no source", "no source").otherwise("faulty")
    return got.select("instance_id", kind.alias("kind"), F.when(F.col("fault").isNull(), patches.count_files(F.col("test_patch"))).otherwise(0).alias("files"))


def _handlers(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Line items of each order as the files of a change, from two sources with different fields."""
    part = F.col("l_partkey").cast("string")
    path = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("tests/p"), part, F.lit(".py"))).when(F.col("l_returnflag") == "A", F.concat(F.lit("src/p"), part, F.lit(".py"))).otherwise("README.md")
    files = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(path.alias("path"), F.lit("@@ -1 +1 @@").alias("hunk"))).alias("files"))
    key = F.col("l_orderkey").cast("string")
    own = files.select(F.col("l_orderkey").alias("row_idx"), F.concat(F.lit("c"), (F.col("l_orderkey") % 5000).cast("string")).alias("commit_id"), F.concat(F.lit("CVE-"), (2012 + F.col("l_orderkey") % 6).cast("string"), F.lit("-"), key).alias("cve_id"), F.array(F.lit("79")).alias("cwe_ids"), "files")
    one = curation.recent(own.filter("row_idx % 2 = 0")).withColumns({"project": F.lit("o/r"), "html_url": F.lit("u"), "commit_date": F.lit("d")})
    two = curation.recent(own.filter("row_idx % 2 = 1")).withColumns({"owner": F.lit("o"), "repo": F.lit("s"), "repo_url": F.lit("https://x/o/s")})
    return [one, two]


COLLECT_SQL = """
WITH f AS (SELECT l_orderkey, CASE l_returnflag WHEN 'R' THEN 'test' WHEN 'A' THEN 'code' ELSE 'docs' END AS side, l_partkey FROM lineitem WHERE 2012 + l_orderkey % 6 >= 2014),
c AS (SELECT l_orderkey AS k, CASE WHEN count(DISTINCT CASE WHEN side = 'code' THEN l_partkey END) > 10 THEN 'too long' WHEN count_if(side = 'code') = 0 THEN 'no target language' WHEN count_if(side = 'test') = 0 THEN 'no tests' END AS reject,
  CASE WHEN l_orderkey % 2 = 0 THEN 'o/r' ELSE 'o/s' END AS project, concat('c', l_orderkey % 5000) AS commit FROM f GROUP BY l_orderkey)"""


@query(f"""{COLLECT_SQL} SELECT concat(replace(project, '/', '__'), '_', commit) AS instance_id, project, commit AS base_commit, concat('CVE-', 2012 + min(k) % 6, '-', min(k)) AS cve_id,
  CASE WHEN project = 'o/r' THEN 'u' ELSE concat('https://x/o/s/commit/', commit) END AS info_page, coalesce(CASE WHEN project = 'o/r' THEN 'd' END, '-') AS created_at FROM c WHERE reject IS NULL GROUP BY project, commit""")
def q_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, _ = collection.collect(_handlers(spark, sf_dir))
    return records.select("instance_id", "project", "base_commit", "cve_id", "info_page", F.coalesce("created_at", F.lit("-")).alias("created_at"))


@query(f"{COLLECT_SQL} SELECT k AS row_idx, reject FROM c WHERE reject IS NOT NULL")
def q_collect_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = collection.collect(_handlers(spark, sf_dir))
    return rejected.select("row_idx", "reject")


@query("""
SELECT l_orderkey, CASE WHEN l_orderkey % 7 = 0 THEN 0 WHEN l_orderkey % 7 = 1 THEN -1 ELSE count(DISTINCT l_partkey) END AS files, l_orderkey % 7 = 1 AS faulty FROM lineitem GROUP BY l_orderkey""")
def q_with_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from patchloom.queries import _patches

    kind = F.col("l_orderkey") % 7
    own = _patches(spark, sf_dir).withColumn("patch", F.when(kind == 0, F.when(F.col("l_orderkey") % 2 == 0, "no header")).when(kind == 1, F.concat("patch", F.lit("diff --git a/x b/y\n--- a/x\n+++ b/y\n"))).otherwise(F.col("patch")))
    got = patches.with_files(own)
    return got.select("l_orderkey", F.coalesce(F.size("files"), F.lit(-1)).cast("bigint").alias("files"), F.col("error").isNotNull().alias("faulty"))


@query("""
SELECT o_orderkey, concat('p', o_custkey) AS patch FROM orders WHERE o_orderkey % 3 = 0 AND year(o_orderdate) >= 2014 UNION ALL
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 1 THEN concat('f', o_orderkey) END FROM orders WHERE o_orderkey % 3 = 1 AND year(o_orderdate) >= 2014 UNION ALL SELECT o_orderkey, concat('q', o_orderstatus) FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 50 = 0""")
def q_crawl_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    year = F.when((F.col("o_orderkey") % 3 == 0) & (F.col("o_orderkey") % 50 == 0), "2020").otherwise(F.year("o_orderdate").cast("string"))
    patch = F.when(F.col("o_orderkey") % 3 == 0, F.when(F.col("o_orderkey") % 50 == 0, F.concat(F.lit("q"), "o_orderstatus")).otherwise(F.concat(F.lit("p"), F.col("o_custkey").cast("string"))))
    commits = F.when(F.col("o_orderkey") % 3 == 2, F.array(F.struct(F.lit("a").alias("commit_sha")), F.struct(F.lit("b").alias("commit_sha")))).otherwise(F.array(F.struct(key.alias("commit_sha"))))
    rows = o.select("o_orderkey", F.lit("o").alias("owner"), F.lit("r").alias("repo"), F.concat(F.lit("CVE-"), year, F.lit("-1")).alias("cve_id"), commits.alias("commits"), patch.alias("patch"))
    fetched = o.filter("o_orderkey % 2 = 1").select(F.lit("o").alias("owner"), F.lit("r").alias("repo"), key.alias("sha"), F.concat(F.lit("f"), key).alias("patch"))
    return collection.crawl_plan(rows, fetched).select("o_orderkey", "patch")


@query("SELECT p_partkey, p_brand FROM part WHERE p_size > 25")
def q_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _t(spark, sf_dir, "part").withColumn("html_url", F.concat(F.lit("u"), F.col("p_partkey").cast("string")))
    return curation.live(part, part.select(F.col("html_url").alias("url"), F.when(F.col("p_size") > 25, 200).otherwise(404).alias("status"))).select("p_partkey", "p_brand")


@query("SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def q_strict_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return relational.strict_lookup(_t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), names, "o_custkey").drop("o_custkey")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey IN (1, 2, 3, 5, 8, 13, 21, 34)")
def q_only_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.only_ids(_t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", [1, 2, 3, 5, 8, 13, 21, 34])


@query(f"""
SELECT p_partkey, concat(p_name, {_sql_text(" \n\n---\n " + render.GENERIC + render.ORACLE)}, '- **b', p_size % 7, '**: ', p_size % 7, chr(10)) AS statement FROM part WHERE p_size % 7 <> 3
UNION ALL SELECT p_partkey, concat(p_name, {_sql_text(" \n\n---\n " + render.GENERIC + render.ORACLE)}) FROM part WHERE p_size % 7 = 3""")
def q_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _t(spark, sf_dir, "part")
    own = part.select(F.col("p_partkey").alias("instance_id"), F.col("p_name").alias("problem_statement"), F.array(F.concat(F.lit("b"), (F.col("p_size") % 7).cast("string"))).alias("cwe_ids"))
    names = part.select((F.col("p_size") % 7).alias("n")).distinct().filter("n <> 3").select(F.concat(F.lit("b"), F.col("n").cast("string")).alias("id"), F.col("n").cast("string").alias("name"))
    return stages.prepared(own, "oracle", names).select(F.col("instance_id").alias("p_partkey"), F.col("problem_statement").alias("statement"))


@query(f"""SELECT p_partkey, 'docker' AS deployment, CASE WHEN p_size > 25 THEN concat('i', p_size) ELSE 'python:3.11' END AS image, 'w' AS repo, 'HEAD' AS commit, concat(p_name, {_sql_text(" \n\n---\n " + render.GENERIC)}) AS text FROM part""")
def q_agent_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    image = F.when(F.col("p_size") > 25, F.concat(F.lit("i"), F.col("p_size").cast("string")))
    own = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("instance_id"), F.col("p_name").alias("problem_statement"), image.alias("image_name"))
    got = stages.evaluation_tasks(own, "generic", "w")
    return got.select(F.col("problem_statement.id").alias("p_partkey"), F.col("env.deployment.type").alias("deployment"), F.col("env.deployment.image").alias("image"), F.col("env.repo.repo_name").alias("repo"), F.col("env.repo.base_commit").alias("commit"), F.col("problem_statement.text").alias("text"))


@query("""
WITH own AS (SELECT p_partkey, p_size FROM part WHERE p_partkey % 5 <> 0)
SELECT p_partkey, least(8.0, min(round(77 / p_size, 1)) OVER (ORDER BY p_partkey ROWS UNBOUNDED PRECEDING)) AS ratio FROM own""")
def q_mask_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.array_join(F.array_repeat(F.lit("+x"), F.col("p_size")), "\n")
    own = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("instance_id"), F.col("p_partkey").alias("_pos"), F.concat(line, F.lit("\n")).alias("security_patch"))
    starts = own.filter("instance_id % 5 <> 0").select("instance_id", F.lit("c").alias("rollback"))
    got = stages.mask_requests(own, starts, "{ratio} of {diff_patch}", 8, 77)
    return got.filter(F.startswith("statement", F.col("ratio").cast("string"))).select(F.col("instance_id").alias("p_partkey"), "ratio")


def _agent_run(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Parts as tasks, with predictions, exit statuses and checks of an agent run."""
    part = _t(spark, sf_dir, "part").withColumnRenamed("p_partkey", "instance_id")
    predictions = part.filter("p_size <> 7").select("instance_id", F.when(F.col("p_size") == 8, "").when(F.col("p_size") == 9, "--- /dev/null").otherwise(F.concat(F.lit("m"), F.col("p_size").cast("string"))).alias("model_patch"))
    statuses = part.groupBy(F.when(F.col("p_size") % 5 == 0, "exit_cost").when(F.col("p_size") % 2 == 0, "submitted").otherwise("skipped (submitted)").alias("status")).agg(F.collect_list("instance_id").alias("instance_ids"))
    checks = part.select("instance_id", (F.col("p_size") % 6 != 0).alias("patch_applies"))
    return part, predictions, statuses, checks


RUN_OK = "p_size NOT IN (7, 8) AND p_size % 5 <> 0 AND p_size % 6 <> 0"


@query(f"SELECT p_partkey, CASE WHEN {RUN_OK} AND p_size <> 9 THEN concat('m', p_size) WHEN p_partkey % 2 = 0 THEN 'old' END AS mask FROM part WHERE p_partkey % 2 = 0 OR ({RUN_OK} AND p_size <> 9)")
def q_stage_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, predictions, statuses, checks = _agent_run(spark, sf_dir)
    tasks = part.filter("instance_id % 2 = 0").select("instance_id", F.lit("old").alias("mask_patch"))
    got, _ = stages.with_masks(tasks, part.select("instance_id"), predictions, statuses, checks)
    return got.select(F.col("instance_id").alias("p_partkey"), F.col("mask_patch").alias("mask"))


@query(f"SELECT p_partkey, CASE WHEN {RUN_OK} AND p_size % 7 <> 2 THEN CASE WHEN p_size % 7 = 1 THEN 'latest' ELSE p_name END END AS statement FROM part")
def q_stage_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, predictions, statuses, checks = _agent_run(spark, sf_dir)
    new = part.select("instance_id", F.when(F.col("p_size") % 7 == 2, "run tests").when(F.col("p_size") % 7 == 1, "latest").otherwise(F.col("p_name")).alias("problem_statement"))
    got, _ = stages.with_statements(part.select("instance_id"), new, predictions, statuses, checks)
    return got.select(F.col("instance_id").alias("p_partkey"), F.col("problem_statement").alias("statement"))


@query(f"SELECT p_partkey FROM part WHERE {RUN_OK} AND p_size % 4 <> 1 AND p_size % 7 <> 3 AND p_size % 11 <> 2")
def q_stage_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, predictions, statuses, checks = _agent_run(spark, sf_dir)
    verdict = F.when(F.col("p_size") % 7 == 3, "{}").when(F.col("p_size") % 11 == 2, '{"excessive_implementations": true, "explanation": "e"}').otherwise('{"excessive_implementations": false, "explanation": "e"}')
    results = part.select("instance_id", verdict.alias("result"), F.lit("t").alias("task_patch"), (F.col("p_size") % 4 != 1).alias("reapplied"))
    got, _ = stages.with_verdicts(part.select("instance_id"), results, predictions, statuses, checks)
    return stages.finished_tasks(got).select(F.col("instance_id").alias("p_partkey"))


@query("SELECT p_partkey FROM part WHERE NOT (p_size > 10 AND p_size % 2 = 0)")
def q_stage_retried(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _t(spark, sf_dir, "part").withColumnRenamed("p_partkey", "instance_id")
    good = part.filter("p_size > 10")
    return stages.retried(part, good, good.select("instance_id", (F.col("p_size") % 2 == 0).alias("verified"))).select(F.col("instance_id").alias("p_partkey"))


@query("SELECT p_partkey, CAST(1 AS INTEGER) AS num_files_edited, CAST(p_size AS INTEGER) AS num_lines_edited, CASE WHEN p_size > 20 THEN CAST(p_size + 1 AS INTEGER) ELSE -1 END AS num_sec_tests FROM part")
def q_stage_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("instance_id"), "p_size", F.concat(F.lit("+++ b/x\n"), F.repeat(F.lit("-x\n"), F.col("p_size"))).alias("mask_patch"))
    tests = own.filter("p_size > 20").select("instance_id", (F.col("p_size") + 1).alias("num_sec_tests"), F.lit(0).alias("num_func_tests"))
    return stages.merged_stats(stages.task_stats(own), tests).select(F.col("instance_id").alias("p_partkey"), "num_files_edited", "num_lines_edited", F.coalesce("num_sec_tests", F.lit(-1)).alias("num_sec_tests"))


@query("SELECT p_partkey, CASE WHEN p_size % 16 < 7 THEN '3.7' WHEN p_size % 16 > 12 THEN '3.12' ELSE concat('3.', p_size % 16) END AS version FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 7 <> 0 AND p_brand <> 'Brand#1'")
def q_dev_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("p_partkey") % 3 == 0, "cobol").otherwise("python")
    version = F.when(F.col("p_partkey") % 7 != 0, F.concat(F.lit("Python 3."), (F.col("p_size") % 16).cast("string"), F.lit(".2")))
    part = _t(spark, sf_dir, "part").withColumnRenamed("p_partkey", "instance_id").withColumn("p_partkey", F.col("instance_id"))
    tools = stages.dev_tools(part.select("instance_id", F.to_json(F.struct(name.alias("name"), version.alias("version"))).alias("result")))
    return stages.environment_requests(part.withColumn("project", F.col("p_brand")), tools, ["Brand#1"]).select("p_partkey", "version")


@query("""
SELECT p_partkey, concat('FROM a:', p_size, chr(10), 'CMD x', chr(10)) AS dockerfile, CAST(CASE WHEN p_size % 2 = 0 THEN 9 ELSE 0 END AS INTEGER) AS ignored FROM part WHERE p_size % 5 <> 0""")
def q_environment_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    block = lambda path, *lines: F.concat(F.lit(f"diff --git a/{path} b/{path}\n--- /dev/null\n+++ b/{path}\n@@ -0,0 +1,9 @@\n"), *(F.concat(F.lit("+"), x if isinstance(x, Column) else F.lit(x), F.lit("\n")) for x in lines))
    size = F.col("p_size")
    patch = F.concat(block("sub/Dockerfile", "FROM no"), F.when(size % 5 != 0, block("Dockerfile", F.concat(F.lit("FROM a:"), size.cast("string")), "CMD x")).otherwise(""), F.when(size % 2 == 0, block(".dockerignore", "*.log")).otherwise(""))
    good, _ = stages.environment_specs(_t(spark, sf_dir, "part").select(F.col("p_partkey").alias("instance_id"), patch.alias("model_patch")))
    return good.select(F.col("instance_id").alias("p_partkey"), "dockerfile", F.when(F.col("dockerignore") == "", 0).otherwise(F.size(F.split("dockerignore", "\n", -1))).alias("ignored"))


@query("SELECT p_partkey, concat('diff --git a/m.py b/m.py', chr(10), '--- a/m.py', chr(10), '+++ b/m.py', chr(10), '@@ -1,2 +1,3 @@', chr(10), ' a', chr(10), '+', p_size, chr(10), ' c', chr(10)) AS golden FROM part WHERE p_size % 3 <> 0")
def q_golden_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    sources = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("instance_id"), F.lit("m.py").alias("path"), F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("a\n"), size, F.lit("\nc\n"))).otherwise("a\nc\n").alias("masked"), F.concat(F.lit("a\n"), size, F.lit("\nc\n")).alias("base"))
    tasks = sources.select("instance_id", F.lit("x").alias("mask_patch"), F.array(F.lit("t")).alias("test_files"))
    return stages.dataset_records(tasks, stages.golden_patches(sources)).select(F.col("instance_id").alias("p_partkey"), F.col("golden_patch").alias("golden"))


@query("SELECT count(*) AS tasks, count(DISTINCT p_brand) AS projects, count(DISTINCT p_type) AS weaknesses, avg(p_size) AS mean_lines FROM part")
def q_dataset_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _t(spark, sf_dir, "part").select(F.col("p_brand").alias("project"), F.array("p_type").alias("cwe_ids"), F.repeat(F.lit("+x\n"), F.col("p_size")).alias("golden_patch"))
    return curation.dataset_numbers(own)


@query("SELECT count(*) AS total, count_if(coalesce(quality, 0) = 1)::BIGINT AS succeeded, count_if(coalesce(quality, 0) <> 1)::BIGINT AS failed FROM labels")
def q_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.progress(_t(spark, sf_dir, "labels"), F.col("quality") == 1)


@query("""
WITH n AS (SELECT user_id, count_if(event_type = 'view')::INTEGER AS b, count_if(event_type = 'click')::INTEGER AS r, count_if(event_type = 'signup')::INTEGER AS p, count_if(event_type = 'purchase')::INTEGER AS t, count_if(event_type = 'error')::INTEGER AS k FROM events GROUP BY user_id)
SELECT user_id, CASE WHEN b + r + p + t + k = 0 THEN 'rejected' WHEN t < b OR (user_id % 2 = 0 AND k < r) THEN 'doubtful' ELSE 'accepted' END AS verdict FROM n""")
def q_parser_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = lambda e: F.count_if(F.col("event_type") == e).cast("int")
    c = _t(spark, sf_dir, "events").groupBy("user_id").agg(n("view").alias("b"), n("click").alias("r"), n("signup").alias("p"), n("purchase").alias("t"), n("error").alias("k"))
    return c.select("user_id", curation.parser_accepted(F.col("b"), F.col("r"), F.col("p"), F.col("t"), F.col("k"), F.lit(True), F.col("user_id") % 2 == 0).alias("verdict"))


@query("SELECT p_partkey, CASE WHEN p_size < 10 THEN 'image_name missing' WHEN p_size < 20 THEN 'problem_statement missing' END AS error FROM part")
def q_required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _t(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") >= 10, "i").alias("image_name"), F.when(F.col("p_size") >= 20, "s").otherwise("").alias("problem_statement"))
    return curation.required_fields(own).select("p_partkey", "error")


@query("""
SELECT p_partkey, 'problem_statement.md' AS file, p_name AS text FROM part UNION ALL
SELECT p_partkey, 'golden.md', concat('```diff', chr(10), chr(10), '+', p_size, chr(10), '```') FROM part WHERE p_size > 5 UNION ALL
SELECT p_partkey, 'meta_info.md', concat(chr(10), '# Meta Information', chr(10), chr(10), 'Project: ', p_brand, chr(10), chr(10), 'Vulnerability fix commit: [Github Page](u)', chr(10), chr(10), 'Security issue identifier: c', chr(10), chr(10), 'Vulnerability type: 79, ', p_type, chr(10), chr(10)) FROM part""")
def q_rendered_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    golden = F.when(F.col("p_size") > 5, F.concat(F.lit("+"), F.col("p_size").cast("string")))
    own = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("instance_id"), F.col("p_name").alias("problem_statement"), golden.alias("golden_patch"), F.col("p_brand").alias("project"), F.lit("u").alias("info_page"), F.lit("c").alias("cve_id"), F.array(F.lit("79"), F.col("p_type")).alias("cwe_ids"))
    return writers.rendered_tasks(own).withColumnRenamed("instance_id", "p_partkey")


@query("""
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN concat('git apply --ignore-space-change --reverse /build_data/patches/g/0.patch') WHEN p_size % 3 = 1 THEN 'git apply --ignore-space-change /build_data/patches/g/0.patch && git apply --ignore-space-change /build_data/patches/g/1.patch' ELSE '' END AS command FROM part""")
def q_patch_command(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_size") % 3
    own = F.when(kind == 0, F.array(F.lit("p"), F.lit("-R"))).when(kind == 1, F.array(F.lit("p"), F.lit("q"))).otherwise(F.array().cast("array<string>"))
    return _t(spark, sf_dir, "part").select("p_partkey", render.patch_command(own, "g").alias("command"))


@query("""
SELECT p_partkey, concat('FROM --platform=x me/i:', p_size, ' AS b', chr(10), 'RUN git config --global user.email setup@localhost && git config --global user.name setup', chr(10), 'RUN mkdir -p build_data', chr(10), 'COPY . /build_data/', chr(10),
  'RUN git reset --hard c', p_size, ' && git clean -fdq', chr(10), 'RUN git apply --ignore-space-change /build_data/patches/pre_install/0.patch', chr(10), CASE WHEN p_size > 9 THEN concat('RUN install', chr(10)) ELSE '' END,
  'RUN git add . && git commit --allow-empty -m "Instance created." --no-verify', chr(10), 'RUN rm -rf -- /build_data', chr(10), 'CMD t', chr(10)) AS dockerfile FROM part""")
def q_instance_dockerfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    docker = F.lit("FROM --platform=x base:1 AS b\nRUN a\nCOPY . .\nRUN install\nCMD t\n")
    got = render.instance_dockerfile(docker, F.concat(F.lit("me/i:"), size), F.concat(F.lit("c"), size), F.array(F.lit("p")), F.array().cast("array<string>"), F.col("p_size") > 9)
    return _t(spark, sf_dir, "part").select("p_partkey", got.alias("dockerfile"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN concat('{\"a\": ', p_size, '}') ELSE concat('{\"b\": ', p_size, '}') END AS json, concat('u/f.x86_64.eval_', lower(p_brand), '_c', p_size) AS image FROM part")
def q_rendered_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    own = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit('said ```{"a": '), size, F.lit("}``` so"))).otherwise(F.concat(F.lit('{"b": '), size, F.lit("}")))
    instance = F.concat("p_brand", F.lit("__c"), size)
    return _t(spark, sf_dir, "part").select("p_partkey", render.fenced_json(own).alias("json"), text.hub_image_name(instance, "u", "f").alias("image"))


@query("SELECT p_partkey, p_partkey % 5 = 0 AS code, CASE p_partkey % 5 WHEN 0 THEN '.py' WHEN 1 THEN '.gz' WHEN 4 THEN '.md' ELSE '' END AS suffix FROM part")
def q_path_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.element_at(F.array(*(F.lit(x) for x in ("a/b.c/d.py", "d.tar.gz", ".gitignore", "a.b/Makefile", "x.md"))), (F.col("p_partkey") % 5 + 1).cast("int"))
    return _t(spark, sf_dir, "part").select("p_partkey", text.known_code(path).alias("code"), text.suffix(path).alias("suffix"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 4 <> 1")
def q_still_to_do(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return writers.still_to_do(o, o.filter("o_orderkey % 4 = 1"), "o_orderkey")


@query("SELECT p_partkey FROM part WHERE p_size % 12 IN (4, 10, 16) OR p_size % 12 = 4")
def q_adaptive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stages in two rounds: even sizes pass the first, and those of a remainder that the round's ratio sets the second."""
    part = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("instance_id"), "p_size")
    done = adaptive.adaptive(part, [lambda rows, ratio, cap: rows.filter("p_size % 2 = 0"), lambda rows, ratio, cap: rows.filter(F.col("p_size") % 12 == ratio)], ratios=[4, 10])
    return done.select(F.col("instance_id").alias("p_partkey"))


@query("SELECT event_type, count(*) AS reports, count_if(value > 50)::BIGINT AS passes FROM events GROUP BY event_type")
def q_pass_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window counts of the stream's plan, over a table that is whole: one window for each type."""
    days = F.element_at(F.create_map(*(x for i, k in enumerate(("click", "error", "purchase", "signup", "view")) for x in (F.lit(k), F.lit(i)))), F.col("event_type"))
    at = F.date_add(F.lit("2024-01-01").cast("date"), days).cast("timestamp")
    own = _t(spark, sf_dir, "events").select(at.alias("finished_at"), F.struct((F.col("value") > 50).alias("pass")).alias("func"), F.struct(F.lit(True).alias("pass")).alias("sec"))
    counts = streams.pass_counts(own, "1 day")
    kinds = F.element_at(F.array(*(F.lit(k) for k in ("click", "error", "purchase", "signup", "view"))), F.dayofmonth("window.start"))
    return counts.select(kinds.alias("event_type"), "reports", "passes")


RUN_DAYS = 2


@query(f"""
WITH c AS (SELECT user_id, event_id AS seq, CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'end' ELSE 'log' END AS kind, props AS data, epoch_ms(ts) AS ms FROM events),
b AS (SELECT user_id, min(ms) AS begun FROM c GROUP BY user_id),
t AS (SELECT c.* FROM c JOIN b USING (user_id) WHERE ms < begun + {RUN_DAYS * 86_400_000}),
z AS (SELECT * FROM t WHERE kind <> 'log' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ms, seq) = 1),
p AS (SELECT t.user_id, string_agg(t.data, '' ORDER BY t.seq) AS logs, count(*) AS chunks FROM t LEFT JOIN z USING (user_id) WHERE t.kind = 'log' AND (z.user_id IS NULL OR (t.ms, t.seq) < (z.ms, z.seq)) GROUP BY t.user_id)
SELECT b.user_id, coalesce(p.logs, '') AS logs, z.user_id IS NULL AS timed_out, CASE WHEN z.kind = 'error' THEN z.data END AS error, coalesce(p.chunks, 0) AS chunks
FROM b LEFT JOIN z USING (user_id) LEFT JOIN p USING (user_id)""")
def q_finished_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as chunks of their users' runs; what the stream of chunks gives once all are due."""
    kind = F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "signup", "end").otherwise("log")
    own = _t(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("instance_id"), F.lit("func").alias("run_name"), F.col("event_id").alias("seq"), kind.alias("kind"), F.encode("props", "utf-8").alias("data"), F.col("ts").alias("at"))
    got = runs.runs_of_table(own, F.lit("2100-01-01").cast("timestamp"), RUN_DAYS * 86_400_000)
    return got.select(F.col("instance_id").cast("bigint").alias("user_id"), "logs", "timed_out", "error", "chunks")


@query("""
WITH b AS (SELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority, o_orderkey % 3 AS part FROM orders),
l AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY o_custkey, part ORDER BY o_orderkey DESC) = 1),
f AS (SELECT o_custkey, min(part) AS first, max(part) AS last FROM l GROUP BY o_custkey)
SELECT f.o_custkey, z.o_orderkey, z.o_totalprice, a.o_orderpriority FROM f JOIN l a ON a.o_custkey = f.o_custkey AND a.part = f.first JOIN l z ON z.o_custkey = f.o_custkey AND z.part = f.last""")
def q_keyed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders come in three batches, the second one twice; each sets two columns of the customers it has, and adds new ones whole."""
    own = _t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority")
    table = KeyedTable.create(spark, f"{shared_folder(spark)}/merged-{uuid.uuid4().hex}", own.schema, "o_custkey", 8)
    for number in (0, 1, 1, 2):
        table.merge(own.filter(F.col("o_orderkey") % 3 == number), ["o_orderkey"], ["o_orderkey", "o_totalprice"], "orders", number)
    return table.read()


@query("""
SELECT l_orderkey, CASE WHEN l_orderkey % 7 = 1 THEN 'path changed to y.py' WHEN count_if(l_returnflag = 'R') = 0 THEN 'other language or no tests' END AS reject, concat('c', l_orderkey) AS commit_id,
  CASE WHEN l_orderkey % 7 = 1 THEN -1 ELSE count(DISTINCT CASE l_returnflag WHEN 'R' THEN concat('t', l_partkey) WHEN 'A' THEN concat('s', l_partkey) ELSE 'r' END) END AS files
FROM lineitem WHERE l_orderkey % 7 <> 0 GROUP BY l_orderkey""")
def q_crawled_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order's line items as one patch text; some are empty, and some rename a file."""
    part = F.col("l_partkey").cast("string")
    path = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("tests/p"), part, F.lit(".py"))).when(F.col("l_returnflag") == "A", F.concat(F.lit("src/p"), part, F.lit(".py"))).otherwise("README.md")
    files = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set(path).alias("paths"))
    changed = F.transform("paths", lambda p: F.struct(p.alias("path"), F.lit("@@ -1 +1 @@\n-a\n+b").alias("hunk")))
    kind = F.col("l_orderkey") % 7
    patch = F.when(kind == 0, "").when(kind == 1, "diff --git a/x.py b/y.py\n--- a/x.py\n+++ b/y.py\n").otherwise(patches.merged_patch(changed))
    lines = files.select("l_orderkey", patch.alias("patch"), F.array(F.struct(F.concat(F.lit("c"), F.col("l_orderkey").cast("string")).alias("commit_sha"))).alias("commits"))
    got = collection.judged_changes(lines)
    return got.select("l_orderkey", "commit_id", F.coalesce(F.size("files"), F.lit(-1)).cast("bigint").alias("files"), "reject")


@query("SELECT DISTINCT p_brand AS project FROM part")
def q_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collection.projects(_t(spark, sf_dir, "part").withColumnRenamed("p_brand", "project"))


@query("SELECT p_partkey, p_size % 5 <> 0 AND p_size % 4 <> 0 AS good FROM part")
def q_verified_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose patches apply; some have no check."""
    part = _t(spark, sf_dir, "part").withColumnRenamed("p_partkey", "instance_id")
    checks = part.filter("p_size % 5 <> 0").select("instance_id", (F.col("p_size") % 4 != 0).alias("patch_applies"))
    good, bad = collection.verified_records(part, checks)
    named = lambda df, ok: df.select(F.col("instance_id").alias("p_partkey"), F.lit(ok).alias("good"))
    return named(good, True).unionByName(named(bad, False))


@query("SELECT p_partkey, p_name FROM part WHERE p_size % 3 <> 0")
def q_without_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("instance_id"), "p_name", "p_size")
    return stages.without_results(part, part.filter("p_size % 3 = 0").select("instance_id")).select(F.col("instance_id").alias("p_partkey"), "p_name")


@query("SELECT o_orderkey, o_orderkey % 4 IN (0, 3) AS valid FROM orders")
def q_valid_parser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps of patterns by turns: a failure's, no failure's, an unknown status, an empty pattern beside an error's."""
    maps = [{"FAILED": r"(\d+) failed", "PASSED": ""}, {"PASSED": r"(\d+) passed"}, {"ODD": "x", "FAILED": "y"}, {"FAILED": "", "ERROR": "e"}]
    turn = F.col("o_orderkey") % 4
    parser = F.coalesce(*(F.when(turn == i, F.create_map(*(F.lit(x) for pair in m.items() for x in pair))) for i, m in enumerate(maps)))
    return _t(spark, sf_dir, "orders").select("o_orderkey", logs.valid_parser(parser).alias("valid"))
