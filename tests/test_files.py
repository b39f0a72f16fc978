"""Files read in splits by entry, and written under their own names."""

import json
import os

import pytest
from pyspark.sql import functions as F

from patchloom.functions import render
from patchloom.sources import named_files, readers, writers


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_keyed_documents_in_splits(spark, tmp_path, small_splits):
    records = {f'k"{i}\n' if i == 7 else f"k{i}": {"v": i, "patch": f'line\n  "k{i}": {{"v": 0}},\n}}' * (i % 5), "tags": ["a", f"{i}"] if i % 2 else []} for i in range(600)}
    (tmp_path / "preds.json").write_text(json.dumps(records, ensure_ascii=False, indent=2))
    (tmp_path / "one.json").write_text(json.dumps({"single": {"v": 1, "patch": "é x", "tags": None}}, ensure_ascii=False, indent=2))
    (tmp_path / "none.json").write_text("{}")
    schema = "v int, patch string, tags array<string>"
    got = {r["instance_id"]: (r["v"], r["patch"], r["tags"]) for r in readers.keyed_entries(spark, str(tmp_path), schema).collect()}
    want = {k: (r["v"], r["patch"], r["tags"]) for k, r in records.items()} | {"single": (1, "é x", None)}
    assert got == want
    assert spark.read.text(str(tmp_path / "preds.json")).rdd.getNumPartitions() > 5
    whole = {r["instance_id"]: r["v"] for r in readers.keyed_json(spark, str(tmp_path / "preds.json"), schema).collect()}
    assert whole == {k: r["v"] for k, r in records.items()}


def test_repeated_and_bad_entries(spark, tmp_path):
    (tmp_path / "a.json").write_text('{\n  "k": {\n    "v": 1\n  },\n  "k": {\n    "v": 2\n  }\n}\n')
    assert [tuple(r) for r in readers.keyed_entries(spark, str(tmp_path / "a.json"), "v int").collect()] == [("k", 2)]
    (tmp_path / "b.json").write_text('{\n  "k": {\n    "v": oops\n  }\n}')
    with pytest.raises(Exception, match="[Mm]alformed"):
        readers.keyed_entries(spark, str(tmp_path / "b.json"), "v int").collect()


def test_yaml_lists_in_splits(spark, tmp_path, small_splits):
    yaml = pytest.importorskip("yaml")
    statuses = {"submitted": [f"o__r_{i}" for i in range(900)], "skipped (submitted)": ["a: b", "it's", "- x", "1"], "exit_cost": [], "it's: odd": ["y"]}
    (tmp_path / "s.yaml").write_text(yaml.dump({"instances_by_exit_status": statuses}, allow_unicode=True, sort_keys=False))
    got = readers.keyed_lists(spark, str(tmp_path / "s.yaml")).orderBy("status", "pos").collect()
    want = sorted((s, i, x) for s, own in statuses.items() for i, x in enumerate(own))
    assert [tuple(r) for r in got] == want
    rows = readers.yaml_documents(spark, str(tmp_path / "s.yaml"), "instances_by_exit_status map<string,array<string>>").collect()
    assert rows[0]["row"]["instances_by_exit_status"] == statuses


def test_files_are_written_by_name(spark, tmp_path):
    out = str(tmp_path / "tasks")
    tasks = spark.createDataFrame([(f"i{n}", f"say {n}\n", "+x", "p", "u", "CVE-1", ["CWE-1", "CWE-2"]) for n in range(20)], "instance_id string, problem_statement string, golden_patch string, project string, info_page string, cve_id string, cwe_ids array<string>")
    named_files.write_files(writers.rendered_tasks(tasks).repartition(4), out)
    assert sorted(os.listdir(out)) == sorted(f"i{n}" for n in range(20))
    assert sorted(os.listdir(f"{out}/i3")) == ["golden.md", "meta_info.md", "problem_statement.md"]
    assert open(f"{out}/i3/problem_statement.md").read() == "say 3\n" and open(f"{out}/i3/golden.md").read() == "```diff\n\n+x\n```"
    reports = spark.createDataFrame([("i3", (True, "completion"), None)], "instance_id string, func struct<pass:boolean,status:string>, sec struct<pass:boolean,status:string>")
    named_files.write_files(named_files.rendered_reports(reports), out)
    assert open(f"{out}/i3/report.json").read() == json.dumps({"func": {"pass": True, "status": "completion"}, "sec": None}, indent=2)
    assert len(os.listdir(f"{out}/i3")) == 4


def test_a_failed_write_leaves_no_file(spark, tmp_path):
    out = str(tmp_path / "tasks")
    schema = "instance_id string, file string, text string"
    for bad in ([("a", "x.md", "1"), ("..", "x.md", "2")], [("a", "x.md", "1"), ("a", None, "2")], [("a", "x.md", "1"), ("a", "x.md", "2")], [("a", "x.md", "1"), ("/etc", "y", "2")]):
        with pytest.raises(Exception, match="not a file name|named twice"):
            named_files.write_files(spark.createDataFrame(bad, schema).repartition(2), out)
        assert [f for _, _, own in os.walk(out) for f in own] == [] and not any("_pending" in d for d in os.listdir(out))
    named_files.write_files(spark.createDataFrame([("a", "x.md", None)], schema), out)
    assert open(f"{out}/a/x.md").read() == ""


def test_indented_json(spark):
    df = spark.createDataFrame([([("a", None)],)], "v array<struct<k:string,n:int>>").coalesce(1)
    assert df.select(render.indented_json(F.col("v"))).first()[0] == json.dumps([{"k": "a", "n": None}], indent=2)
