import json

from pyspark.sql import functions as F

from patchloom.operators import curation, relational, scoring
from patchloom.plans import adaptive, collection, evaluation
from patchloom.sources import readers, writers


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_keep_first_and_last_wins(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, "z")], "k string, o int, v string")
    assert rows(relational.keep_first(df, "k", ["o"]), "k", "v") == [("a", "y"), ("b", "z")]
    assert rows(relational.last_wins(df, "k", ["o"]), "k", "v", "__first.o") == [("a", "x", 1), ("b", "z", 3)]


def test_keep_first_sorts_only_what_is_asked_for(spark):
    """Columns that a plan leaves out are not aggregated; those it has come from one row, also among equals in order."""
    df = spark.range(4000).selectExpr("id % 50 AS k", "id DIV 400 AS o", "id AS a", "repeat(cast(id AS string), 9) AS wide").repartition(6)
    first = relational.keep_first(df, "k", ["o"])
    assert "wide" not in first.select("k", "a")._jdf.queryExecution().executedPlan().toString()
    got = first.collect()
    assert len(got) == 50 and all(r["wide"] == str(r["a"]) * 9 and r["a"] % 50 == r["k"] and r["o"] == 0 for r in got)
    assert relational.keep_first(df.select("k"), "k", ["k"]).count() == 50


def test_upsert_and_update(spark):
    old = spark.createDataFrame([("a", 1, "p"), ("b", 2, "q")], "k string, v int, w string")
    new = spark.createDataFrame([("b", 20, "r"), ("c", 30, "s")], "k string, v int, w string")
    assert rows(relational.upsert(old, new, "k", ["v"]), "k", "v", "w") == [("a", 1, "p"), ("b", 20, "q"), ("c", 30, "s")]
    assert rows(relational.update_matched(old, new, "k", "v"), "k", "v", "w") == [("a", 1, "p"), ("b", 20, "q")]
    assert rows(relational.only_ids(old, "k", None), "k") == [("a",), ("b",)] and relational.only_ids(old, "k", []).count() == 0


def test_bag_difference(spark):
    left = spark.createDataFrame([("i", n, v) for n, v in enumerate("xxy")], "i string, n int, v string")
    right = spark.createDataFrame([("i", n, v) for n, v in enumerate("xyxxz")], "i string, n int, v string")
    got = relational.bag_difference(left, right, ["i"], "v", "n").orderBy("n").collect()
    assert [r["v"] for r in got] == ["x", "z"]


def test_balanced_split(spark):
    for n, parts, want in ((10, 4, [3, 3, 2, 2]), (2, 4, [1, 1])):
        got = relational.balanced_split(spark.range(n), parts, "id").groupBy("bucket").count().orderBy("bucket").collect()
        assert [r["count"] for r in got] == want


def test_balanced_split_of_wide_rows(spark):
    """Two million rows with a wide column: each bucket is a contiguous run of the right length."""
    n, parts = 2_000_000, 7
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("id"), F.repeat(F.lit("x"), 40).alias("wide"), F.lit(0).alias("bucket"), F.lit(1).alias("part"))
    got = relational.balanced_split(df, parts, "id")
    assert got.columns == ["id", "wide", "part", "bucket"]
    at, small, extra = F.col("id"), n // parts, n % parts
    want = F.when(at < extra * (small + 1), F.floor(at / (small + 1))).otherwise(extra + F.floor((at - extra * (small + 1)) / small)) + 1
    assert got.agg(F.count("*").alias("n"), F.count_if(F.col("bucket") != want).alias("wrong")).first() == (n, 0)


def test_running_ratio(spark):
    df = spark.createDataFrame([(0, 100), (1, 600), (2, 50)], "o int, n int")
    assert [r["ratio"] for r in relational.running_least_ratio(df, "n", "o", 5, 1500).orderBy("o").collect()] == [5.0, 2.5, 2.5]


def test_nearest_version(spark):
    df = spark.createDataFrame([("3.6",), ("3.13",), ("2.7",), ("3.9.1",)], "v string").coalesce(1)
    assert [r[0] for r in df.select(relational.nearest_version(F.col("v"), ["3.7", "3.8", "3.9", "3.10", "3.11", "3.12"])).collect()] == ["3.7", "3.12", "3.7", "3.9"]


def test_interval_and_prefix(spark):
    spans = spark.createDataFrame([("f", 1, 3), ("f", 5, 6), ("g", 1, 9)], "f string, s int, e int")
    points = spark.createDataFrame([("f", 3), ("f", 4)], "f string, n int")
    assert rows(relational.interval_semi_join(spans, points, ["f"], "s", "e", "n"), "f", "s") == [("f", 1)]


def test_selection(spark):
    df = spark.createDataFrame([(["79", "79", "20"], ["79", "22"]), ([], ["1"])], "s array<string>, g array<string>").coalesce(1)
    got = [tuple(r["q"]) for r in df.select(scoring.selection_quality(F.col("s"), F.col("g")).alias("q")).collect()]
    assert got == [(1 / 3, 0.5), (0.0, 0.0)]
    bad = spark.createDataFrame([("no json",), ('{"selected_cwes": ["a"]}',)], "t string").coalesce(1)
    assert [tuple(r[0]) for r in bad.select(scoring.selection_quality_of_text(F.col("t"), F.array(F.lit("a")))).collect()] == [(0.0, 0.0), (1.0, 1.0)]


def test_outcome_and_summary(spark):
    data = [("a", "completion", 1, "completion", 1), ("b", "completion", 1, "completion", 2), ("c", "timeout", 0, "completion", 0), ("d", "completion", 0, "model_patch_error", 0)]
    df = spark.createDataFrame(data, "instance_id string, fs string, f int, ss string, s int")
    expected = F.struct(F.lit(2).alias("func"), F.lit(0).alias("sec"))
    reports = df.select("instance_id", scoring.outcome(F.col("fs"), F.col("f"), F.col("ss"), F.col("s"), expected).alias("r")).select("instance_id", "r.*")
    assert rows(reports, "instance_id", "func.pass", "sec.pass") == [("a", True, True), ("b", True, False), ("c", False, True), ("d", False, False)]
    r = scoring.eval_summary(reports.filter("instance_id <> 'c'"), spark.range(4)).first()
    assert (r["num_submitted_instances"], r["num_model_patch_errors"], r["correct_ratio"], r["correct_secure_ratio"]) == (3, 1, 0.5, 0.25)
    assert rows(scoring.eval_details(reports.filter("instance_id <> 'c'")), "detail", "instance_id") == [("correct", "a"), ("correct", "b"), ("correct_secure", "a"), ("model_patch_error", "d")]


def test_break_check(spark):
    c = scoring.break_check(*(F.lit(x) for x in (0, 1, 1, 3, 5)), F.lit(True), F.lit(True), F.lit(0), F.lit(0))
    r = spark.range(1).select(c.alias("c")).first()["c"]
    assert (r["accepted"], r["expected_failures"]["func"], r["expected_failures"]["sec"], r["num_sec_tests"], r["num_func_tests"]) == (True, 1, -1, 3, 4)


def test_routing_and_collection(spark):
    hunk = "@@ -1 +1 @@\n-a\n+b"
    files = [("src/a.py", hunk), ("tests/test_a.py", hunk), ("docs/x.md", hunk)]
    schema = "project string, commit_id string, cve_id string, cwe_ids array<string>, files array<struct<path:string,hunk:string>>, row_idx int"
    one = spark.createDataFrame([("p/q", "c1", "CVE-2020-1", ["CWE-1"], files, 0), ("p/q", "c2", "CVE-2010-1", ["CWE-1"], files, 1), ("p/r", "c3", "CVE-2020-2", ["CWE-1"], files[:1], 2)], schema)
    records, rejected = collection.collect([curation.recent(one), one.withColumn("cve_id", F.lit("CVE-2021-9"))])
    got = records.orderBy("instance_id").collect()
    assert [(r["instance_id"], r["cve_id"]) for r in got] == [("p__q_c1", "CVE-2020-1"), ("p__q_c2", "CVE-2021-9")]
    assert rows(rejected, "commit_id", "handler_idx", "reject") == [("c3", 0, "no tests"), ("c3", 1, "no tests")]
    other = one.filter("commit_id = 'c1'").drop("project").withColumns({"owner": F.lit("o"), "repo": F.lit("r"), "repo_url": F.lit("https://h/o/r"), "commit_date": F.lit("2020")})
    assert rows(collection.collect([other])[0], "project", "info_page", "created_at", "base_commit") == [("o/r", "https://h/o/r/commit/c1", "2020", "c1")]
    assert got[0]["test_files"] == ["tests/test_a.py"] and "docs/x.md" in got[0]["test_patch"] and "docs" not in got[0]["security_patch"]
    ok = spark.createDataFrame([(files,), ([("a.java", hunk), ("tests/test_a.py", hunk)],)], "files array<struct<path:string,hunk:string>>").coalesce(1)
    assert [r[0] for r in ok.select(curation.target_language_only(F.col("files"), "python", "python")).collect()] == [True, False]


def test_statement_filter(spark):
    df = spark.createDataFrame([(t,) for t in ("run tests", "contest", "Test", "_test")], "problem_statement string")
    assert rows(curation.mentions_no_test(df), "problem_statement") == [("Test",), ("contest",)]


def test_evaluation_plan(spark):
    predictions = spark.createDataFrame([("i", "m1", "p", 0), ("i", "m2", "p", 1), ("lost", "m", "p", 2)], "instance_id string, model_name_or_path string, model_patch string, _pos int")
    dataset = spark.createDataFrame([("i", (1, 0))], "instance_id string, expected_failures struct<func:int,sec:int>")
    specs = spark.createDataFrame([("i", {"FAILED": r"(\d+) failed"})], "instance_id string, logs_parser map<string,string>")
    run_logs = spark.createDataFrame([("i", "func", "1 failed", False), ("i", "sec", "1 failed", False)], "instance_id string, run_name string, logs string, timed_out boolean")
    done = evaluation.evaluate(predictions, dataset, run_logs, specs)
    r = done.reports.collect()
    assert [(x["model"], x["func"]["pass"], x["sec"]["pass"]) for x in r] == [("m2", True, True)]
    more = dataset.union(spark.createDataFrame([("lost", (1, 0)), ("bare", (0, 0))], dataset.schema)).withColumn("cwe_ids", F.array(F.lit("1")))
    asked = predictions.union(spark.createDataFrame([("bare", "m", "p", 3)], predictions.schema))
    broken = specs.union(spark.createDataFrame([("lost", {"FAILED": "("})], specs.schema))
    logs = run_logs.union(spark.createDataFrame([("lost", "func", "x", False)], run_logs.schema))
    done = evaluation.evaluate(asked, more, logs, broken, selection=True)
    assert [x["instance_id"] for x in done.reports.collect()] == ["i"] and done.reports.first()["cwes_selection"]["precision"] == 0.0
    assert sorted((x["instance_id"], x["status"], x["fault"].split()[0]) for x in done.skipped.collect()) == [("bare", "internal_error", "no"), ("lost", "internal_error", "pattern")]
    unbuilt = evaluation.evaluate(asked.filter("instance_id = 'lost'"), more, logs.limit(0), specs.union(spark.createDataFrame([("lost", {"FAILED": "x"})], specs.schema)))
    assert [(x["func"]["status"], x["func"]["pass"]) for x in unbuilt.reports.collect()] == [("model_patch_error", False)]
    old = spark.createDataFrame([("i", "old", (False, "timeout"), (False, "timeout"))], "instance_id string, model string, func struct<pass:boolean,status:string>, sec struct<pass:boolean,status:string>")
    assert [x["model"] for x in evaluation.evaluate(predictions, dataset, run_logs, specs, finished=old).reports.collect()] == ["old"]
    assert [x["model"] for x in evaluation.evaluate(predictions, dataset, run_logs, specs, finished=old, force=True).reports.collect()] == ["m2"]


def test_predictions_lose_what_tests_touch(spark):
    block = "diff --git a/{0} b/{0}\n--- a/{0}\n+++ b/{0}\n@@ -1 +1 @@\n-a\n+b\n"
    predictions = spark.createDataFrame([("i", "m", block.format("t.py") + block.format("s.py"), 0)], "instance_id string, model_name_or_path string, model_patch string, _pos int")
    dataset = spark.createDataFrame([("i", block.format("t.py"))], "instance_id string, test_patch string")
    assert evaluation.filtered_predictions(predictions, dataset).first()["filtered_patch"] == block.format("s.py")


def test_adaptive(spark):
    tasks = spark.createDataFrame([("a", 2), ("b", 8), ("c", 1000)], "instance_id string, need int")
    got = adaptive.adaptive(tasks, [lambda df, ratio, cap: df.filter(F.col("need") <= ratio)])
    assert rows(got, "instance_id") == [("a",)]
    got = adaptive.adaptive(tasks.filter("need < 9"), [lambda df, ratio, cap: df.filter(F.col("need") <= ratio * 4)])
    assert rows(got, "instance_id") == [("a",), ("b",)]


def test_readers(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"instance_id": "a", "v": 1}\nnot json\n\n{"instance_id": "b", "v": 2}\n')
    good, bad = readers.split_corrupt(readers.json_lines(spark, str(tmp_path / "a.jsonl"), "instance_id string, v int", tolerant=True).cache())
    assert rows(good, "instance_id", "v") == [("a", 1), ("b", 2)] and bad.count() == 1
    (tmp_path / "preds.json").write_text(json.dumps({"x": {"v": 1}, "y": {"v": 2}}))
    assert rows(readers.keyed_json(spark, str(tmp_path / "preds.json"), "v int"), "instance_id", "v") == [("x", 1), ("y", 2)]
    (tmp_path / "doc.json").write_text(json.dumps([{"v": 1}, {"v": 2}]))
    assert rows(readers.json_document(spark, str(tmp_path / "doc.json"), "v int"), "v") == [(1,), (2,)]
    assert rows(readers.status_lists(spark, "instances_by_exit_status:\n  submitted:\n  - a\n  - b\n"), "status", "instance_ids") == [("submitted", ["a", "b"])]
    where = tmp_path / "runs/r/generic/m/i"
    where.mkdir(parents=True)
    (where / "report.json").write_text(json.dumps({"func": {"pass": True, "status": "completion"}}))
    got = readers.reports(spark, str(tmp_path / "runs"), "func struct<pass:boolean,status:string>")
    assert rows(got, "run_id", "strategy", "model", "instance_id", "func.pass") == [("r", "generic", "m", "i", True)]
    writers.reports(got, str(tmp_path / "out"))
    assert writers.still_to_do(got, spark.read.parquet(str(tmp_path / "out"))).count() == 0


def test_streaming(spark, tmp_path):
    from patchloom.streaming import reports

    (tmp_path / "in").mkdir()
    lines = [{"run_id": "r", "instance_id": i, "finished_at": f"2024-01-01T00:0{n}:00Z"} for n, i in enumerate("aab")]
    (tmp_path / "in/x.json").write_text("\n".join(map(json.dumps, lines)))
    stream = reports.once(reports.report_stream(spark, str(tmp_path / "in"), "run_id string, instance_id string, finished_at timestamp"))
    reports.write_table(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(60)
    assert rows(spark.read.parquet(str(tmp_path / "out")), "instance_id") == [("a",), ("b",)]
