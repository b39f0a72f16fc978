"""Readers and sinks on files, and the stages' rendered rows."""

import json

import pytest
from pyspark.sql import functions as F

from patchloom.functions import render
from patchloom.plans import stages
from patchloom.sources import readers, writers
from patchloom.streaming import reports as streams


def test_strict_lines_fail(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"v": 1}\nnot json\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.json_lines(spark, str(tmp_path / "a.jsonl"), "v int").collect()
    (tmp_path / "b.jsonl").write_text('{"v": 1}\n{"v": null}\n')
    assert [r["v"] for r in readers.json_lines(spark, str(tmp_path / "b.jsonl"), "v int").collect()] == [1, None]


def test_position_at_ingest(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.jsonl").write_text("".join(json.dumps({"v": 100 * k + i}) + "\n" for i in range(40)))
    rows = readers.with_position(readers.json_lines(spark, str(tmp_path), "v int")).repartition(5)
    assert [r["v"] for r in rows.orderBy("_pos").collect()] == [100 * k + i for k in range(3) for i in range(40)]


def test_text_and_yaml_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, None), ("b: c", 2, ["x"])], "k string, v int, l array<string>").coalesce(1)
    writers.yaml_rows(df, str(tmp_path / "y"))
    lines = sorted(r["value"] for r in spark.read.text(str(tmp_path / "y")).collect())
    assert [json.loads(x.removeprefix("- ")) for x in lines] == [{"k": "a", "v": 1, "l": None}, {"k": "b: c", "v": 2, "l": ["x"]}]
    writers.text_lines(df.select(F.col("k").alias("text")), str(tmp_path / "t"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "t")).collect()) == ["a", "b: c"]
    writers.json_lines(df, str(tmp_path / "j"))
    assert readers.json_lines(spark, str(tmp_path / "j"), "k string, v int, l array<string>").orderBy("k").collect()[0]["l"] is None


def test_tasks_as_files(spark, tmp_path):
    tasks = spark.createDataFrame([("i1", "do", "+x", "p", "u", "c", ["79", "22"]), ("i2", "other", None, "p", "u", "c", ["1"])], "instance_id string, problem_statement string, mask_patch string, project string, info_page string, cve_id string, cwe_ids array<string>")
    rows = writers.rendered_tasks(tasks)
    writers.text_files(rows, str(tmp_path / "out"))
    got = {tuple(p.split("=")[1] for p in r["path"].split("/")[-3:-1]): r["text"] for r in readers.whole_text(spark, str(tmp_path / "out" / "*" / "*")).collect()}
    assert got["i1", "mask.md"].strip() == "```diff\n\n+x\n```" and ("i2", "mask.md") not in got
    assert "Vulnerability type: 79, 22" in got["i1", "meta_info.md"] and got["i2", "problem_statement.md"].strip() == "other"


def test_reports_are_reused(spark, tmp_path):
    df = spark.createDataFrame([("r", "s", "m", "a", 1), ("r", "s", "m", "b", 2)], "run_id string, strategy string, model string, instance_id string, v int")
    writers.reports(df, str(tmp_path / "r"))
    writers.reports(df.filter("v = 2").withColumn("v", F.lit(3)), str(tmp_path / "r"), force=True)
    assert [r["v"] for r in spark.read.parquet(str(tmp_path / "r")).collect()] == [3]
    work = spark.createDataFrame([("a",), ("c",)], "instance_id string")
    assert [r[0] for r in writers.still_to_do(work, df).collect()] == ["c"] and writers.still_to_do(work, df, force=True).count() == 2


def test_agent_rows(spark):
    df = spark.createDataFrame([("i", "do it", "/repos/p")], "instance_id string, s string, path string")
    row = stages.agent_tasks(df, F.col("s"), F.col("path"), commit=F.lit("c1")).first()
    assert row["env"]["repo"].asDict() == {"type": "local", "base_commit": "c1", "path": "/repos/p"} and row["env"]["deployment"]["image"] == "python:3.11"
    assert row["problem_statement"].asDict() == {"type": "text", "text": "do it", "id": "i"}
    with pytest.raises(ValueError):
        stages.agent_tasks(df, F.col("s"), F.col("path"), "odd")
    assert stages.strategy_path("/d.x/set.jsonl", "oracle") == "/d.x/set_oracle.jsonl" and stages.strategy_path("/d.x/set", "o") == "/d.x/set_o"


def test_guards(spark):
    df = spark.createDataFrame([("i", "do")], "instance_id string, problem_statement string")
    assert stages.prepared(df, "feedback-driven", feedback_text="look").first()["problem_statement"].endswith("look")
    with pytest.raises(ValueError):
        stages.prepared(df, "feedback-driven")
    assert df.select(render.fenced_json(F.lit("a ``` {} ``` b ``` c"))).first()[0] == " {} "


def test_specs_without_a_dockerfile(spark):
    patch = "diff --git a/Dockerfile b/Dockerfile\n--- /dev/null\n+++ b/Dockerfile\n@@ -0,0 +1 @@\n+FROM x\n"
    df = spark.createDataFrame([("i", patch), ("j", ""), ("k", patch.replace("Dockerfile", "sub/Dockerfile"))], "instance_id string, model_patch string")
    good, bad = stages.environment_specs(df)
    assert [tuple(r) for r in good.collect()] == [("i", "FROM x\n", "")] and sorted(r["instance_id"] for r in bad.collect()) == ["j", "k"]


def test_window_counts_of_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [{"run_id": "r", "instance_id": str(i), "finished_at": f"2024-01-01T00:{i:02d}:00", "func": {"pass": True}, "sec": {"pass": i % 2 == 0}} for i in range(15)]
    (tmp_path / "in" / "a.json").write_text("\n".join(map(json.dumps, rows)))
    stream = streams.report_stream(spark, str(tmp_path / "in"), "run_id string, instance_id string, finished_at timestamp, func struct<pass:boolean>, sec struct<pass:boolean>")
    streams.pass_counts(stream).writeStream.format("memory").queryName("window_counts").outputMode("complete").trigger(availableNow=True).start().awaitTermination(120)
    assert sorted((r["reports"], r["passes"]) for r in spark.table("window_counts").collect()) == [(5, 3), (10, 5)]
