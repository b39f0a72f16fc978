"""The registered queries on the driver's tables: each operator on an analogue, beside its DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchloom.functions import logs, patches, render, text
from patchloom.operators import curation, relational, scoring

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of each user's even and odd events, one line for each, in order of event_id."""
    n = lambda m: (F.col("event_id") % m).cast("string")
    kind = F.col("event_type")
    line = (
        F.when(kind == "view", F.concat(n(5), F.lit(" failed"))).when(kind == "click", F.concat(n(7), F.lit(" passed"))).when(kind == "error", "TypeError: bad").when(kind == "signup", "NameError: name")
        .when(F.col("event_id") % 11 == 0, "INTERNALERROR> x").otherwise(F.concat(n(3), F.lit(" error")))
    )
    side = (F.col("event_id") % 2).alias("side")
    lists = _t(spark, sf_dir, "events").groupBy("user_id", side).agg(F.array_sort(F.collect_list(F.struct("event_id", line.alias("line")))).alias("x"))
    return lists.select("user_id", "side", F.array_join(F.transform("x", lambda x: x["line"]), "\n").alias("logs"), (F.size("x") > 40).alias("timed_out"))


RUN_SQL = """
WITH r AS (
  SELECT user_id, event_id % 2 AS side, CASE WHEN count(*) > 40 THEN 'timeout' WHEN bool_or(event_type = 'purchase' AND event_id % 11 = 0) THEN 'startup_error' ELSE 'completion' END AS status,
         coalesce(arg_max(event_id % 5, event_id) FILTER (WHERE event_type = 'view'), 0) AS failed, coalesce(arg_max(event_id % 7, event_id) FILTER (WHERE event_type = 'click'), 0) AS passed,
         coalesce(arg_max(event_id % 3, event_id) FILTER (WHERE event_type = 'purchase' AND event_id % 11 <> 0), 0) AS errors
  FROM events GROUP BY 1, 2
)"""

#: A full order of line items, whose number in an order is not unique.
ITEM_ORDER = ["l_linenumber", "l_partkey", "l_returnflag", "l_shipdate", "l_suppkey", "l_quantity", "l_extendedprice"]
ITEM_SQL = ", ".join(ITEM_ORDER)


@query("""
SELECT (SELECT count(*) FROM documents) AS num_dataset_instances, count(*) AS num_submitted_instances, count_if(quality = 0 AND toxic = 1)::BIGINT AS num_model_patch_errors,
       count_if(quality = 1) / (SELECT count(*) FROM documents) AS correct_ratio, count_if(quality = 1 AND toxic = 0) / (SELECT count(*) FROM documents) AS correct_secure_ratio
FROM labels""")
def q_eval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    error = (F.col("quality") == 0) & (F.col("toxic") == 1)
    status = F.when(error, "model_patch_error").otherwise("completion")
    reports = _t(spark, sf_dir, "labels").select(F.col("doc_id").alias("instance_id"), F.struct((F.col("quality") == 1).alias("pass"), status.alias("status")).alias("func"), F.struct((F.col("toxic") == 0).alias("pass"), status.alias("status")).alias("sec"))
    return scoring.eval_summary(reports, _t(spark, sf_dir, "documents").select("doc_id"))


@query("""
WITH last AS (SELECT conv_id, arg_max(role, turn) AS role, min(turn) AS first_turn FROM conversations GROUP BY conv_id)
SELECT l.conv_id, l.role, l.first_turn, d.source FROM last l JOIN documents d ON l.conv_id = d.doc_id""")
def q_inner_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = relational.last_wins(_t(spark, sf_dir, "conversations").select("conv_id", "role", "turn"), "conv_id", ["turn"])
    docs = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("conv_id"), "source")
    return last.join(docs, "conv_id").select("conv_id", "role", F.col("__first.turn").alias("first_turn"), "source")


@query("SELECT md5(text) AS key, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def q_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.keep_first(_t(spark, sf_dir, "documents").select(F.md5("text").alias("key"), "doc_id"), "key", ["doc_id"])


@query("SELECT doc_id, lang, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def q_anti_completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.pending(_t(spark, sf_dir, "documents").select("doc_id", "lang", "source"), _t(spark, sf_dir, "labels"), "doc_id")


@query("SELECT doc_id, lang, source FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 1)")
def q_semi_submitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("quality") == 1, "submitted").otherwise("exit_error")
    lists = _t(spark, sf_dir, "labels").groupBy(status.alias("status"), (F.col("doc_id") % 16).alias("part")).agg(F.collect_list("doc_id").alias("instance_ids"))
    return relational.submitted(_t(spark, sf_dir, "documents").select("doc_id", "lang", "source"), lists, "doc_id", ["submitted"])


@query("""
SELECT coalesce(d.doc_id, l.doc_id + 1000000) AS doc_id, CASE WHEN l.doc_id IS NOT NULL THEN 'labelled' ELSE d.source END AS source, d.lang
FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id""")
def q_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = _t(spark, sf_dir, "labels").select("doc_id", F.lit("labelled").alias("source"))
    return relational.upsert(_t(spark, sf_dir, "documents").select("doc_id", "source", "lang"), new, "doc_id", ["source"])


@query("SELECT d.doc_id, d.lang, CASE WHEN l.doc_id IS NOT NULL THEN CAST(l.quality AS VARCHAR) ELSE d.source END AS source FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def q_update_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = _t(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("source"))
    return relational.update_matched(_t(spark, sf_dir, "documents").select("doc_id", "lang", "source"), new, "doc_id", "source")


@query("""
SELECT l_orderkey, lo, hi FROM (SELECT l_orderkey, min(l_shipdate) AS lo, max(l_shipdate) AS hi FROM lineitem GROUP BY 1) s
WHERE EXISTS (SELECT 1 FROM orders o WHERE o_orderkey = l_orderkey AND o_orderdate BETWEEN lo AND hi)""")
def q_interval_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("lo"), F.max("l_shipdate").alias("hi"))
    points = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return relational.interval_semi_join(spans, points, ["l_orderkey"], "lo", "hi", "o_orderdate")


def _lines(df: DataFrame) -> DataFrame:
    return df.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))


@query("""
WITH l AS (SELECT lang, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT line, count(*) AS n FROM ((SELECT line FROM l WHERE lang = 'en') EXCEPT ALL (SELECT line FROM l WHERE lang = 'de')) GROUP BY line""")
def q_bag_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents")
    one, two = (_lines(docs.filter(F.col("lang") == x)).withColumn("at", F.struct("doc_id", "pos")) for x in ("en", "de"))
    return relational.bag_difference(two, one, [], "line", "at").groupBy("line").agg(F.count("*").alias("n"))


@query("""
WITH l AS (SELECT source, lang, doc_id, generate_subscripts(w, 1) - 1 AS pos, unnest(w) AS line FROM (SELECT source, lang, doc_id, string_split(text, chr(10)) AS w FROM documents)),
had AS (SELECT source, line, count(*) AS n FROM l WHERE lang = 'de' GROUP BY 1, 2),
s AS (SELECT l.*, row_number() OVER (PARTITION BY l.source, l.line ORDER BY doc_id, pos) AS nth FROM l WHERE lang = 'en')
SELECT s.source, s.doc_id, s.pos, s.line FROM s LEFT JOIN had h ON s.source = h.source AND s.line = h.line WHERE nth > coalesce(h.n, 0)""")
def q_bag_diff_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents")
    rows = docs.select("source", "lang", "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    right = rows.filter("lang = 'en'").withColumn("at", F.struct("doc_id", "pos"))
    return relational.bag_difference(rows.filter("lang = 'de'"), right, ["source"], "line", "at").select("source", "doc_id", "pos", "line")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, CAST(ntile(7) OVER (ORDER BY o_orderkey) AS INTEGER) AS bucket FROM orders")
def q_ntile_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.balanced_split(_t(spark, sf_dir, "orders").drop("o_orderdate"), 7, "o_orderkey")


@query("SELECT o_custkey, o_orderkey, least(5.0, min(round(100000 / o_totalprice, 1)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING)) AS ratio FROM orders")
def q_running_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return relational.running_least_ratio(own, "o_totalprice", "o_orderkey", 5, 100000, by=["o_custkey"]).drop("o_totalprice")


@query("SELECT p_partkey, (SELECT arg_min(v, abs(v - p_size) * 100 + i) FROM (VALUES (0, 5), (1, 12), (2, 20), (3, 33), (4, 47)) t(i, v)) AS nearest FROM part")
def q_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "part").select("p_partkey", relational.nearest(F.col("p_size"), [5, 12, 20, 33, 47]).alias("nearest"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 25 OFFSET 100")
def q_offset_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.page(_t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 100, 25)


@query(r"""SELECT page_id, coalesce(TRY_CAST(list_extract(regexp_extract_all(html, '/([0-9]+)"', 1), -1) AS INTEGER), 0) AS last FROM pages""")
def q_last_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "pages").select("page_id", logs.last_number(F.col("html"), r'/([0-9]+)"').alias("last"))


@query("""
SELECT user_id, event_id % 2 AS side, CAST(count_if(event_type IN ('error', 'signup')) AS INTEGER) AS symbols FROM events GROUP BY 1, 2""")
def q_pattern_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_logs(spark, sf_dir).select("user_id", "side", logs.symbol_errors(F.col("logs")).alias("symbols"))


@query(f"{RUN_SQL} SELECT user_id, side, status FROM r")
def q_status_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_logs(spark, sf_dir).select("user_id", "side", logs.run_status(F.col("logs"), F.col("timed_out")).alias("status"))


@query(f"{RUN_SQL} SELECT user_id FROM r GROUP BY user_id HAVING bool_and(status <> 'timeout' AND status <> 'startup_error')")
def q_runs_allowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = logs.run_status(F.col("logs"), F.col("timed_out"))
    return curation.runs_allowed(run_logs(spark, sf_dir).select("user_id", F.col("side").alias("run_idx"), status.alias("status")), "user_id")


@query("""
WITH r AS (SELECT quality = 1 AS ok, toxic = 0 AS safe, doc_id % 7 / 7.0::DOUBLE AS p, doc_id % 11 / 11.0::DOUBLE AS r FROM labels)
SELECT g AS "group", coalesce(avg(CASE WHEN m THEN p END), 0.0) AS precision, coalesce(avg(CASE WHEN m THEN r END), 0.0) AS recall
FROM (SELECT p, r, unnest(['correct_sol', 'incorrect_sol', 'secure_sol', 'insecure_sol']) AS g, unnest([ok, NOT ok, ok AND safe, ok AND NOT safe]) AS m FROM r) GROUP BY g""")
def q_group_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = F.lit("completion").alias("status")
    reports = _t(spark, sf_dir, "labels").select(F.struct((F.col("quality") == 1).alias("pass"), done).alias("func"), F.struct((F.col("toxic") == 0).alias("pass"), done).alias("sec"), F.struct((F.col("doc_id") % 7 / F.lit(7.0)).alias("precision"), (F.col("doc_id") % 11 / F.lit(11.0)).alias("recall")).alias("cwes_selection"))
    return scoring.selection_means(reports)


@query("""
WITH s AS (SELECT conv_id, list(role) AS sel, ['user', 'system'] AS gt FROM conversations GROUP BY conv_id)
SELECT conv_id, len(list_intersect(sel, gt)) / len(sel) AS precision, len(list_intersect(sel, gt)) / len(gt) AS recall FROM s""")
def q_precision_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list("role").alias("sel"))
    return chosen.select("conv_id", scoring.selection_quality(F.col("sel"), F.array(F.lit("user"), F.lit("system"))).alias("q")).select("conv_id", "q.precision", "q.recall")


@query("""
WITH i AS (SELECT p_partkey, replace(p_brand || '/' || p_type, '/', '__') || '_' || md5(p_name) AS instance_id FROM part)
SELECT p_partkey, instance_id, split_part(instance_id, '_', -1) AS commit, left(split_part(instance_id, '_', -1), 7) AS short,
       replace(left(instance_id, length(instance_id) - length(split_part(instance_id, '_', -1)) - 1), '__', '/') AS project FROM i""")
def q_instance_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _t(spark, sf_dir, "part").select("p_partkey", text.instance_id(F.concat("p_brand", F.lit("/"), "p_type"), F.md5("p_name")).alias("instance_id"))
    i = F.col("instance_id")
    return own.select("p_partkey", i, text.instance_commit(i).alias("commit"), text.short_id(i).alias("short"), text.instance_project(i).alias("project"))


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with an array of (path, hunk), a file for each line item."""
    hunk = lambda x: F.concat(F.lit("@@ -1,2 +1,2 @@\n keep "), x["l_partkey"].cast("string"), F.lit("\n-old "), x["l_returnflag"], F.lit("\n+new "), x["l_linestatus"])
    path = lambda x: F.concat(F.lit("src/p"), x["l_partkey"].cast("string"), F.lit(".py"))
    lists = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(*ITEM_ORDER, "l_linestatus"))).alias("x"))
    return lists.select("l_orderkey", F.transform("x", lambda x: F.struct(path(x).alias("path"), hunk(x).alias("hunk"))).alias("files"))


def _patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _files(spark, sf_dir).select("l_orderkey", patches.merged_patch(F.col("files")).alias("patch"))


PATCH_SQL = f"""
WITH block AS (
  SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY {ITEM_SQL}) AS i, 'src/p' || l_partkey || '.py' AS path,
         concat('@@ -1,2 +1,2 @@', chr(10), ' keep ', l_partkey, chr(10), '-old ', l_returnflag, chr(10), '+new ', l_linestatus) AS hunk FROM lineitem
), synth AS (
  SELECT l_orderkey, string_agg(concat('diff --git a/', path, ' b/', path, chr(10), '--- a/', path, chr(10), '+++ b/', path, chr(10), hunk), chr(10) ORDER BY i) || chr(10) AS patch
  FROM block GROUP BY l_orderkey
)"""


@query(f"{PATCH_SQL} SELECT l_orderkey, patch FROM synth")
def q_patch_synth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _patches(spark, sf_dir)


@query(f"{PATCH_SQL} SELECT l_orderkey, CAST(count(DISTINCT path) AS INTEGER) AS files, CAST(2 * count(*) AS INTEGER) AS lines FROM block GROUP BY l_orderkey")
def q_patch_len(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("patch")
    return _patches(spark, sf_dir).select("l_orderkey", patches.count_files(p).alias("files"), patches.count_lines(p).alias("lines"))


@query(f"{PATCH_SQL} SELECT l_orderkey, CAST(i - 1 AS INTEGER) AS pos, path, hunk FROM block")
def q_patch_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patches.patch_files(_patches(spark, sf_dir), "patch").filter("error IS NULL").select("l_orderkey", "pos", "path", "hunk")


@query(f"""{PATCH_SQL} SELECT l_orderkey, CAST((i - 1) * 7 + k AS INTEGER) AS pos, path FROM block, (SELECT unnest(range(7)) AS k) WHERE k >= 3""")
def q_patch_carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = patches.lines_of_files(_patches(spark, sf_dir), "patch")
    return rows.filter(~F.col("line").rlike(r"^(diff --git|---|\+\+\+) ")).select("l_orderkey", "pos", "path")


@query(f"""{PATCH_SQL} SELECT l_orderkey, coalesce(string_agg(concat('diff --git a/', path, ' b/', path, chr(10), '--- a/', path, chr(10), '+++ b/', path, chr(10), hunk, chr(10)), '' ORDER BY i)
  FILTER (WHERE path NOT IN ('src/p1.py', 'src/p2.py', 'src/p3.py')), '') AS patch FROM block GROUP BY l_orderkey""")
def q_patch_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = patches.filtered_patch(_patches(spark, sf_dir), "patch", ["src/p1.py", "src/p2.py", "src/p3.py"], exclude=True)
    return got.select("l_orderkey", F.col("filtered_patch").alias("patch"))


@query(f"""{PATCH_SQL} SELECT l_orderkey, CAST(i - 1 AS INTEGER) AS pos, unnest(['same', 'removed', 'added']) AS kind, unnest([1, 2, -1]) AS old_ln, unnest([1, -1, 2]) AS new_ln FROM block""")
def q_hunk_lineno(spark: SparkSession, sf_dir: str) -> DataFrame:
    hunks = _files(spark, sf_dir).select("l_orderkey", F.posexplode("files").alias("pos", "f")).select("l_orderkey", "pos", "f.hunk")
    return patches.lines_of_hunks(hunks, "hunk").select("l_orderkey", "pos", "kind", F.coalesce("old_ln", F.lit(-1)).alias("old_ln"), F.coalesce("new_ln", F.lit(-1)).alias("new_ln"))


@query("""
SELECT l_orderkey, bool_or(l_returnflag = 'R') AND coalesce(bool_and(l_quantity < 40) FILTER (WHERE l_returnflag <> 'R'), true) AS ok FROM lineitem GROUP BY l_orderkey""")
def q_lang_quantified(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.when(F.col("l_returnflag") == "R", "tests/a.py").when(F.col("l_quantity") < 40, "src/a.py").otherwise("src/a.go")
    lists = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(path.alias("path"), F.lit("").alias("hunk"))).alias("files"))
    return lists.select("l_orderkey", curation.target_language_only(F.col("files"), "python", "python").alias("ok"))


@query("""
WITH f AS (SELECT l_orderkey, CASE l_returnflag WHEN 'R' THEN 'test' WHEN 'A' THEN 'code' ELSE 'docs' END AS side, l_partkey FROM lineitem)
SELECT l_orderkey, CAST(count_if(side = 'code') AS INTEGER) AS code_blocks, CAST(count_if(side <> 'code') AS INTEGER) AS test_blocks, CAST(count_if(side = 'test') AS INTEGER) AS test_files,
       CASE WHEN count(DISTINCT CASE WHEN side = 'code' THEN l_partkey END) > 10 THEN 'too long' WHEN count_if(side = 'code') = 0 THEN 'no target language' WHEN count_if(side = 'test') = 0 THEN 'no tests' END AS reject
FROM f GROUP BY l_orderkey""")
def q_route_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.col("l_partkey").cast("string")
    path = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("tests/p"), part, F.lit(".py"))).when(F.col("l_returnflag") == "A", F.concat(F.lit("src/p"), part, F.lit(".py"))).otherwise("README.md")
    files = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(path.alias("path"), F.lit("@@ -1 +1 @@").alias("hunk"))).alias("files"))
    blocks = lambda c: F.regexp_count(c, F.lit("diff --git ")).alias
    return curation.routed(files).select("l_orderkey", blocks("security_patch")("code_blocks"), blocks("test_patch")("test_blocks"), F.size("test_files").alias("test_files"), "reject")


@query("SELECT o_orderkey, year(o_orderdate)::INTEGER AS year FROM orders WHERE year(o_orderdate) >= 1998")
def q_year_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    cve = F.concat_ws("-", F.lit("CVE"), F.year("o_orderdate").cast("string"), F.col("o_orderkey").cast("string"))
    return _t(spark, sf_dir, "orders").select("o_orderkey", text.year_of_cve(cve).alias("year")).filter("year >= 1998")


@query("""
WITH n AS (SELECT user_id, CAST(count_if(event_type = 'view') AS INTEGER) AS f, CAST(count_if(event_type = 'error') AS INTEGER) AS s, CAST(count_if(event_type = 'click') AS INTEGER) AS ef, CAST(count_if(event_type = 'signup') AS INTEGER) AS es FROM events GROUP BY user_id)
SELECT user_id, f <= ef AS func_pass, s <= es + least(ef, f) AS sec_pass FROM n""")
def q_expected_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = lambda e: F.count_if(F.col("event_type") == e).cast("int")
    counts = _t(spark, sf_dir, "events").groupBy("user_id").agg(n("view").alias("f"), n("error").alias("s"), F.struct(n("click").alias("func"), n("signup").alias("sec")).alias("expected"))
    done = F.lit("completion")
    return counts.select("user_id", scoring.outcome(done, F.col("f"), done, F.col("s"), F.col("expected")).alias("r")).select("user_id", F.col("r.func.pass").alias("func_pass"), F.col("r.sec.pass").alias("sec_pass"))


@query("""
WITH n AS (SELECT user_id, count_if(event_type = 'view')::INTEGER AS b, count_if(event_type = 'click')::INTEGER AS r, count_if(event_type = 'signup')::INTEGER AS p, count_if(event_type = 'purchase')::INTEGER AS t, count_if(event_type = 'error')::INTEGER AS k FROM events GROUP BY user_id)
SELECT user_id, t > r AND b < t - (r - p) AND r - p >= 0 AND k > r AS accepted, r AS expected_func, b - p AS expected_sec, t - (r - p) - b AS num_sec_tests, k - r AS num_func_tests FROM n""")
def q_break_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = lambda e: F.count_if(F.col("event_type") == e).cast("int")
    c = _t(spark, sf_dir, "events").groupBy("user_id").agg(n("view").alias("b"), n("click").alias("r"), n("signup").alias("p"), n("purchase").alias("t"), n("error").alias("k"))
    check = scoring.break_check(F.col("b"), F.col("r"), F.col("p"), F.col("t"), F.col("k"), F.lit(True), F.lit(True), F.lit(0), F.lit(0))
    return c.select("user_id", check.alias("c")).select("user_id", "c.accepted", F.col("c.expected_failures.func").alias("expected_func"), F.col("c.expected_failures.sec").alias("expected_sec"), "c.num_sec_tests", "c.num_func_tests")


@query("""
WITH c AS (SELECT conv_id, list(DISTINCT role) AS sel FROM conversations GROUP BY conv_id)
SELECT conv_id, CASE WHEN conv_id % 5 = 0 THEN 0.0 ELSE len(list_intersect(sel, ['user', 'system'])) / len(sel) END AS precision,
       CASE WHEN conv_id % 5 = 0 THEN 0.0 ELSE len(list_intersect(sel, ['user', 'system'])) / 2 END AS recall FROM c""")
def q_json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.to_json(F.struct(F.collect_set("role").alias("selected_cwes"))).alias("j"))
    lines = F.concat(F.lit("diff --git a/selected_cwes.json b/selected_cwes.json\n--- /dev/null\n+++ b/selected_cwes.json\n@@ -0,0 +1 @@\n+"), F.when(F.col("conv_id") % 5 == 0, F.lit("{")).otherwise(F.col("j")))
    text_of = patches.added_text(named.select("conv_id", lines.alias("patch")), "patch", "selected_cwes.json", out="text")
    quality = scoring.selection_quality_of_text(F.col("text"), F.array(F.lit("user"), F.lit("system")))
    return text_of.select("conv_id", quality.alias("q")).select("conv_id", "q.precision", "q.recall")


@query("SELECT p_brand, string_agg(concat('- **', p_partkey, '**: ', p_name, chr(10)), '' ORDER BY p_partkey) AS items FROM part GROUP BY p_brand")
def q_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = _t(spark, sf_dir, "part").groupBy("p_brand").agg(F.array_sort(F.collect_list(F.struct(F.col("p_partkey").alias("k"), F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name")))).alias("x"))
    return lists.select("p_brand", render.weakness_list(F.col("x")).alias("items"))


@query("SELECT DISTINCT event_type AS id, concat('name of ', event_type) AS name FROM events WHERE event_type <> 'click'")
def q_set_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _t(spark, sf_dir, "events")
    ids = events.groupBy("user_id").agg(F.collect_list("event_type").alias("cwe_ids"))
    names = events.select(F.col("event_type").alias("id")).distinct().filter("id <> 'click'").withColumn("name", F.concat(F.lit("name of "), F.col("id")))
    return render.all_weaknesses(ids, names)


@query("""
WITH u AS (SELECT 0 AS h, c_custkey AS k, c_nationkey AS nation, c_name AS name FROM customer UNION ALL SELECT 1, s_suppkey, s_nationkey, s_name FROM supplier)
SELECT nation, name, h AS handler_idx FROM (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY h, k) AS n FROM u) WHERE n = 1""")
def q_union_handlers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("nation"), F.col("c_name").alias("name"))
    s = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"))
    return relational.keep_first(relational.union_handlers(c, s), "nation", ["handler_idx", "k"]).select("nation", "name", "handler_idx")


@query("""
SELECT p_partkey, coalesce((SELECT bool_or(starts_with(p_type, x)) FROM (VALUES ('Brand#11', 'STANDARD'), ('Brand#11', 'SMALL'), ('Brand#22', 'PROMO'), ('Brand#33', 'ECONOMY')) v(b, x) WHERE b = p_brand), false) AS banned FROM part""")
def q_prefix_theta(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefixes = spark.createDataFrame([("Brand#11", "STANDARD"), ("Brand#11", "SMALL"), ("Brand#22", "PROMO"), ("Brand#33", "ECONOMY")], "p_brand string, prefix string")
    return relational.prefix_match(_t(spark, sf_dir, "part"), prefixes, "p_brand", "p_type", "prefix", "banned").select("p_partkey", "banned")


@query(r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS w FROM documents)
SELECT doc_id, array_to_string(list_slice(w, greatest(1, len(w) - 4), len(w)), ' ') AS tail FROM w""")
def q_tail_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").select("doc_id", text.tail_words(F.col("text"), 5).alias("tail"))


@query("""
SELECT p_partkey, CASE WHEN v IN ('3.7', '3.8', '3.9', '3.10', '3.11', '3.12') THEN v ELSE
  (SELECT arg_min(a, abs(n - (3 * 100 + p_size % 16)) * 100 + i) FROM (VALUES (0, '3.7', 307), (1, '3.8', 308), (2, '3.9', 309), (3, '3.10', 310), (4, '3.11', 311), (5, '3.12', 312)) t(i, a, n)) END AS version
FROM (SELECT p_partkey, p_size, concat('3.', p_size % 16) AS v FROM part)""")
def q_nearest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    from patchloom.schemas import DEV_TOOL_VERSIONS

    raw = F.concat(F.lit("v3."), (F.col("p_size") % 16).cast("string"), F.lit(".1rc"))
    return _t(spark, sf_dir, "part").select("p_partkey", relational.nearest_version(raw, DEV_TOOL_VERSIONS["python"]).alias("version"))


@query("SELECT count(*) AS total, count_if(quality = 1)::BIGINT AS successful, count_if(coalesce(quality, 0) <> 1)::BIGINT AS failed, sum(CAST(toxic AS DOUBLE)) AS elapsed_time FROM labels")
def q_process_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.process_summary(_t(spark, sf_dir, "labels").select((F.col("quality") == 1).alias("success"), F.col("toxic").cast("double").alias("elapsed_time")))


@query(f"""{PATCH_SQL}, sized AS (SELECT l_orderkey, count(DISTINCT path) AS files, 2 * count(*) AS lines, count_if(path LIKE '%7.py') AS hit FROM block GROUP BY l_orderkey)
SELECT count(*) AS patches, count_if(files <= 3)::BIGINT AS short_patches, count_if(files <= 3 AND hit > 0)::BIGINT AS routed, count_if(files <= 3) / count(*) AS short_ratio, sum(lines)::BIGINT AS lines FROM sized""")
def q_patch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("patch")
    sized = _patches(spark, sf_dir).select(patches.count_files(p).alias("files"), patches.count_lines(p).alias("lines"), F.exists(patches.touched_files(p), lambda x: F.endswith(x, F.lit("7.py"))).alias("hit"))
    short = F.col("files") <= 3
    got = sized.agg(F.count("*").alias("patches"), F.count_if(short).alias("short_patches"), F.count_if(short & F.col("hit")).alias("routed"), F.sum("lines").alias("lines"))
    return got.withColumn("short_ratio", F.try_divide("short_patches", "patches"))
