from patchloom.operators import curation
from patchloom.plans import collection, feedback, masking

BEFORE = "import x\n\ndef test_a():\n    assert x\n\ndef test_b():\n    assert 1\n\ndef helper():\n    pass\n"
AFTER = "import x\nimport y\n\ndef test_a():\n    assert x\n\ndef test_b():\n    assert 1\n    assert 2\n\ndef helper():\n    pass\n"
HUNKS = "@@ -1,2 +1,3 @@\n import x\n+import y\n \n@@ -6,3 +7,4 @@\n def test_b():\n     assert 1\n+    assert 2\n "


def test_masked_tests(spark):
    df = spark.createDataFrame([(1, HUNKS, BEFORE, AFTER), (2, "", "def broken(", "")], "file_id int, hunks string, before string, after string")
    got = {r["file_id"]: r["mask"] for r in masking.masked_tests(df).collect()}
    removed = [x for x in got[1].splitlines() if x.startswith("-")]
    assert removed == ["-def test_b():", "-    assert 1"] and got[1].startswith("@@") and got[2] is None
    assert masking.masked_tests(df).filter("file_id = 2").first()["fault"].startswith("SyntaxError")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_files_are_masked_where_they_are(spark):
    """No shuffle, and files that share an id are masked each by their own hunks."""
    other = "@@ -3,2 +3,2 @@\n-def test_a():\n+def test_a(): \n     assert x"
    df = spark.createDataFrame([(1, HUNKS, BEFORE, AFTER), (1, other, BEFORE, BEFORE.replace("test_a():", "test_a(): "))], "file_id int, hunks string, before string, after string")
    got = masking.masked_tests(df)
    assert "Exchange" not in plan_of(got)
    assert sorted(r["masked"] for r in got.collect()) == sorted([BEFORE.replace("def test_b():\n    assert 1\n", ""), BEFORE.replace("def test_a():\n    assert x\n", "")])


def test_masks_are_expanded_in_one_pass(spark):
    """Tests, other files, missing sources, faulty sources and faulty patches, with each source read once."""
    patch = lambda path, hunks: f"diff --git a/{path} b/{path}\n--- a/{path}\n+++ b/{path}\n{hunks}\n"
    texts = {"good": patch("tests/test_x.py", HUNKS) + patch("x.py", "@@ -1 +1 @@\n-a\n+b"), "gone": patch("tests/test_y.py", HUNKS), "bad": patch("tests/test_x.py", HUNKS), "loose": "diff --git a/x.py b/y.py\n", "none": None}
    records = spark.createDataFrame(list(texts.items()), "instance_id string, test_patch string")
    sources = spark.createDataFrame([("good", "tests/test_x.py", BEFORE, AFTER), ("good", "x.py", "a\n", "b\n"), ("bad", "tests/test_x.py", "def (", AFTER)], "instance_id string, path string, before string, after string")
    got = {r["instance_id"]: r for r in masking.restored(records, sources).collect()}
    assert {k: r["fault"] for k, r in got.items()} == {"good": None, "gone": "no source", "bad": "SyntaxError: invalid syntax", "loose": "path changed to y.py", "none": "no files"}
    assert {k: r["test_patch"] for k, r in got.items() if k != "good"} == {k: t for k, t in texts.items() if k != "good"}
    new = got["good"]["test_patch"]
    assert new.startswith(patch("tests/test_x.py", "@@ -1,8 +1,12 @@\n import x\n+import y\n")[:-1]) and "+def test_b():" in new and new.endswith(patch("x.py", "@@ -1 +1 @@\n-a\n+b"))
    good, bad = masking.expanded_masks(records, sources)
    assert [r["instance_id"] for r in good.collect()] == ["good"] and bad.count() == 4
    assert plan_of(masking.restored(records, sources)).count("Scan ExistingRDD") == 3


def test_changes_are_judged_in_one_pass(spark):
    """Each patch is parsed once, whether it is accepted or not."""
    patch = lambda path, to=None: f"diff --git a/{path} b/{to or path}\n--- a/{path}\n+++ b/{to or path}\n@@ -1 +1 @@\n-a\n+b\n"
    rows = [(1, patch("tests/t.py") + patch("x.py") + patch("x.py"), [("c1",)]), (2, patch("x.py"), []), (3, patch("x.py", "y.py"), [("c3",)]), (4, "", [("c4",)]), (5, None, [("c5",)])]
    lines = spark.createDataFrame(rows, "k int, patch string, commits array<struct<commit_sha:string>>").repartition(2)
    got = collection.judged_changes(lines)
    assert plan_of(got).count("ArrowEvalPython") == 1
    assert sorted((r["k"], r["commit_id"], r["reject"], r["files"] and [f["path"] for f in r["files"]]) for r in got.collect()) == [(1, "c1", None, ["tests/t.py", "x.py"]), (2, None, "other language or no tests", ["x.py"]), (3, "c3", "path changed to y.py", None)]
    good, bad = collection.crawled_changes(lines)
    assert [r["k"] for r in good.collect()] == [1] and sorted(r["k"] for r in bad.collect()) == [2, 3]


def test_feedback(spark):
    reports = spark.createDataFrame([("i", (True,), (False,)), ("j", (True,), (True,))], "instance_id string, func struct<pass:boolean>, sec struct<pass:boolean>")
    logs = spark.createDataFrame([("i", "func", "x\nx\ny\n"), ("i", "sec", "x\ny\nx\nx\nz\n"), ("j", "func", ""), ("j", "sec", "a")], "instance_id string, run_name string, logs string")
    assert [tuple(r) for r in feedback.security_feedback(reports, logs).collect()] == [("i", ["x", "z"])]


def test_small_filters(spark):
    results = spark.createDataFrame([('{"excessive_implementations": false, "explanation": "e"}',), ('{"excessive_implementations": true, "explanation": "e"}',), ("{}",), (None,)], "result string").coalesce(1)
    assert [tuple(r) for r in curation.verified(results).select("successful", "verified").collect()] == [(True, True), (True, False), (False, False), (False, False)]
    checks = spark.createDataFrame([("i", True), ("i", False), ("j", True)], "instance_id string, patch_applies boolean")
    ids = spark.createDataFrame([("i",), ("j",)], "instance_id string")
    assert [r[0] for r in curation.applicable(ids, checks).collect()] == ["j"]
