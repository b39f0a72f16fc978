from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from pyspark.sql import functions as F

from patchloom.functions import logs, patches, render, text
from patchloom.schemas import STARTUP_ERROR_PATTERNS, SYMBOL_ERROR_PATTERNS

PATCH = """junk
diff --git a/src/a.py b/src/a.py
index 1..2 100644
--- a/src/a.py
+++ b/src/a.py
@@ -1,3 +1,3 @@
 keep
-old
+new
 tail
diff --git a/tests/test_b.py b/tests/test_b.py
--- a/tests/test_b.py
+++ b/tests/test_b.py
@@ -5 +5,2 @@
-x
+y
+z
"""


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("value", ["a\r\nb\rc\x0bd\x0ce\x1cf\x85g\u2028h\u2029i j\n", "", "\n", "a\n\n"])
def test_split_lines_is_python_splitlines(spark, value):
    assert one(spark, text.split_lines(F.col("v")), value) == value.splitlines()


def test_identifiers(spark):
    assert one(spark, text.instance_project(F.col("v")), "a__b__c_deadbeef") == "a/b/c"
    assert one(spark, text.instance_commit(F.col("v")), "a__b__c_deadbeef") == "deadbeef"
    assert one(spark, text.short_id(F.col("v")), "a__b_0123456789") == "0123456"
    assert one(spark, text.suffix(F.col("v")), "a.b/.py") == ""
    assert one(spark, text.suffix(F.col("v")), "a/x.test.py") == ".py"


def test_versions(spark):
    assert one(spark, text.clean_version(F.col("v")), "v3.10.2rc1") == "3.10"
    assert one(spark, text.version_number(F.col("v")), "3.10") == 310
    assert one(spark, text.version_number(F.col("v")), "3") == 3


def test_rounding_is_pythons(spark):
    values = [0.35, 0.15, 0.25, 2.5, 1500 / 700, 0.05]
    got = spark.createDataFrame([(v,) for v in values], "v double").select(text.round_half_even_exact(F.col("v"), F.lit(1)).alias("r")).collect()
    assert [r["r"] for r in got] == [round(v, 1) for v in values] == [float(Decimal(v).quantize(Decimal("0.1"), ROUND_HALF_EVEN)) for v in values]


def test_touched_files_and_lines(spark):
    assert one(spark, patches.touched_files(F.col("v")), "+++ b/x.py\t2020\n+++ /dev/null\n") == ["x.py", "/dev/null"]
    assert one(spark, patches.count_lines(F.col("v")), "+x\n--- a comment\n keep") == 1
    assert one(spark, patches.count_files(F.col("v")), PATCH) == 2
    assert one(spark, patches.count_lines(F.col("v")), PATCH) == 5


def test_strict_parse_and_merge(spark):
    rows = list(patches.file_patches(PATCH))
    assert [(p, e) for p, _, e in rows] == [("src/a.py", None), ("tests/test_b.py", None)]
    merged = "\n".join(f"diff --git a/{p} b/{p}\n--- a/{p}\n+++ b/{p}\n{h}" for p, h, _ in rows) + "\n"
    assert [r[:2] for r in patches.file_patches(merged)] == [r[:2] for r in rows]
    files = spark.createDataFrame([([(p, h) for p, h, _ in rows],)], "v array<struct<path:string,hunk:string>>")
    assert files.select(patches.merged_patch(F.col("v"))).first()[0] == merged


@pytest.mark.parametrize("bad", ["diff --git a/x b/y\n--- a/x\n+++ b/y\n", "diff --git a/x b/x\n--- /dev/null\n+++ b/x\n", "diff --git a/x b/x\n--- a/x\n", "diff --git a/x b/x\nrename from x\n--- a/x\n+++ b/x\n", "diff --git a/x b/x\n--- a/z\n+++ b/x\n", "diff --git a/b b/b\nBinary files differ\ndiff --git a/x b/x\n--- a/x\n+++ b/x\n"])
def test_strict_parse_faults(bad):
    assert list(patches.file_patches(bad))[-1][2] is not None


def test_filtered_patch(spark):
    df = spark.createDataFrame([("i", PATCH)], "instance_id string, p string")
    kept = patches.filtered_patch(df, "p", ["src/a.py"], exclude=True).first()["filtered_patch"]
    gone = patches.filtered_patch(df, "p", ["src/a.py"]).first()["filtered_patch"]
    assert gone + kept == PATCH[PATCH.index("diff") :]
    assert kept.startswith("diff --git a/tests/test_b.py")
    odd = "before\ndiff --git a/x b/y z\n+1\ndiff --git odd\n+2\ndiff --git a/q b/q\n+3"
    by_row = spark.createDataFrame([(odd, ["y z"]), (odd, ["q", "x"]), (odd, None), (None, ["q"])], "p string, t array<string>")
    assert [r["filtered_patch"] for r in patches.filtered_patch(by_row, "p", "t").collect()] == ["diff --git a/x b/y z\n+1\n", "diff --git a/x b/y z\n+1\ndiff --git a/q b/q\n+3", "", ""]


def test_with_files(spark):
    twice = "diff --git a/x b/x\n--- a/x\n+++ b/x\n@@ -1 +1 @@\n-a\n+b\n"
    df = spark.createDataFrame([(0, None), (1, "no header"), (2, twice + twice.replace("+b", "+c")), (3, "diff --git a/x b/y\n--- a/x\n+++ b/y\n")], "k int, patch string")
    got = {r["k"]: r for r in patches.with_files(df).collect()}
    assert len(got) == 4 and got[0]["files"] == got[1]["files"] == [] and [(f["path"], f["hunk"][-2:]) for f in got[2]["files"]] == [("x", "+c")]
    assert got[3]["files"] is None and got[3]["error"] and got[2]["error"] is None


def test_tail_tokens(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    path = public_tokenizers.path("word_bpe_49k.json")
    df = spark.createDataFrame([("one two  three, four",), ("one",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(text.tail_tokens(F.col("t"), path, 3)).collect()] == ["three, four", "one", "", None]


def test_paths_are_not_trimmed(spark):
    assert one(spark, patches.touched_files(F.col("v")), "+++ b/a b \t2020\r\n+++ c\x0b+++ b/b/d\n x+++ e") == ["a b ", "c", "b/d"]


def test_hunk_lines(spark):
    df = spark.createDataFrame([("@@ -5 +5,2 @@\n keep\n-x\n+y\n+z",), (None,)], "h string")
    assert [tuple(r)[1:] for r in patches.lines_of_hunks(df, "h").collect()] == [("same", 5, 5), ("removed", 6, None), ("added", None, 6), ("added", None, 7)]


def test_test_spans(spark):
    source = "import x\n@deco\ndef test_a():\n    pass\nclass T:\n    async def test_b(self):\n        pass\ndef other():\n    pass\n"
    df = spark.createDataFrame([(source,), ("def broken(:",), (None,)], "s string")
    got = patches.test_spans(df, "s").collect()
    assert sorted(tuple(r)[1:4] for r in got if r["fault"] is None) == [("test_a", 2, 4), ("test_b", 6, 7)]
    assert [r["name"] for r in got if r["fault"]] == [None]


def test_selected_file_text(spark):
    patch = 'diff --git a/selected_cwes.json b/selected_cwes.json\n--- /dev/null\n+++ b/selected_cwes.json\n@@ -0,0 +1 @@\n+{"selected_cwes": ["a"]}\ndiff --git a/o b/o\n+++ b/o\n@@ -0,0 +1 @@\n+no'
    df = spark.createDataFrame([(patch,), (None,), ("+++ b/x/selected_cwes.json\n+no hunk\n@@ -0,0 +1 @@\n+yes\n+++no\n-gone",)], "p string")
    assert [r["text"] for r in patches.added_text(df, "p", "selected_cwes.json").collect()] == ['{"selected_cwes": ["a"]}', "", "yes"]


def test_status_precedence_and_last_match(spark):
    df = spark.createDataFrame([("Traceback x", True), ("  Traceback x", False), ("E\r\nx", False), ("a E\nx", False), ("INTERNALERROR> y", False)], "logs string, timed_out boolean")
    assert [r[0] for r in df.select(logs.run_status(F.col("logs"), F.col("timed_out"))).collect()] == ["timeout", "startup_error", "startup_error", "completion", "startup_error"]
    log = "1 failed, 2 passed\r\nx\n3 failed, 9 passed\n"
    assert one(spark, logs.last_number(F.col("v"), r"(\d+) failed"), log) == 3
    assert one(spark, logs.last_number(F.col("v"), r"(\d+) error"), log) == 0
    counts = logs.parsed_counts(F.col("v"), {"FAILED": r"(\d+) failed", "ERROR": "", "PASSED": r"(\d+) passed"})
    assert one(spark, counts, log) == {"FAILED": 3, "PASSED": 9}
    assert one(spark, logs.failures(counts), log) == 3
    parsers = [({"FAILED": r"(?P<n>\d+) failed", "ERROR": ""}, {"FAILED": 3}, False), ({"FAILED": "("}, None, True), ({"FAILED": r"\d+ failed"}, None, True), ({"FAILED": r"(x)|\d+ failed"}, None, True), (None, {}, False)]
    by_row = spark.createDataFrame([(log, p) for p, _, _ in parsers], "l string, p map<string,string>")
    got = [r[0] for r in by_row.select(logs.parsed_by_rows(F.col("l"), F.col("p"))).collect()]
    assert [(r["counts"], r["fault"] is not None) for r in got] == [(c, f) for _, c, f in parsers]


def test_patterns_without_a_group(spark):
    df = spark.createDataFrame([("no digit",), ("3 passed",), (None,)], "l string").coalesce(1)
    faults = {strict: [r[0] is not None for r in df.select(logs.parsed_by_rows(F.col("l"), F.create_map(F.lit("FAILED"), F.lit(r"\d+")), strict)["fault"]).collect()] for strict in (False, True)}
    assert faults == {False: [False, True, False], True: [True, True, True]}


def test_patterns_agree_with_python(spark):
    import random
    import re

    draw = random.Random(3)
    pieces = ["Traceback", "\n", "\r\n", " ", "E", "Testing against Django 3", "errors during collection", "TypeError:", "NameError: name", "Applying x OK", "IndentationError: unexpected indent", "\x85", "INTERNALERROR>", "AttributeError: no attribute", "\x1c"]
    texts = ["".join(draw.choice(pieces) for _ in range(draw.randint(0, 6))) for _ in range(150)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    every = STARTUP_ERROR_PATTERNS + SYMBOL_ERROR_PATTERNS
    got = df.select(*(F.regexp_count("t", F.lit(logs.java_pattern(p))).alias(f"c{i}") for i, p in enumerate(every))).collect()
    assert [list(r) for r in got] == [[len(re.findall(p, t, re.M)) for p in every] for t in texts]


def test_valid_parser(spark):
    rows = [({"FAILED": "x"}, True), ({"PASSED": "x"}, False), ({"FAILED": "", "ERROR": "y"}, True), ({"ODD": "x", "ERROR": "y"}, False), ({}, False)]
    df = spark.createDataFrame([(m,) for m, _ in rows], "m map<string,string>").coalesce(1)
    assert [r[0] for r in df.select(logs.valid_parser(F.col("m"))).collect()] == [ok for _, ok in rows]


def test_render(spark):
    names = spark.createDataFrame([("1", "one"), ("2", "two")], "id string, name string")
    df = spark.createDataFrame([("i", "do", ["2", "x", "1"])], "instance_id string, problem_statement string, cwe_ids array<string>")
    assert render.guarded(df, "oracle", names).first()["problem_statement"].endswith("items: \n- **2**: two\n- **1**: one\n")
    assert render.guarded(df, "generic").first()["problem_statement"].startswith("do \n\n---\n ## Safety")
    assert render.guarded(df, "self-selection", names).first()["problem_statement"].endswith("- **1**: one\n- **2**: two\n")
    with pytest.raises(ValueError):
        render.guarded(df, "odd")
    docker = "FROM a:1\nRUN x\nCOPY . .\nRUN y\nCMD run\n"
    assert [one(spark, render.dockerfile_part(F.col("v"), i), docker) for i in range(1, 6)] == ["FROM a:1\n", "RUN x\n", "COPY . .\n", "RUN y\n", "CMD run\n"]
    assert one(spark, render.with_image(F.col("v"), "me$/img:2"), "FROM a:1\n") == "FROM me$/img:2\n"
    assert one(spark, render.with_image(F.col("v"), "i"), "FROM --platform=x  a:1 AS b\n") == "FROM --platform=x  i AS b\n"
    assert one(spark, render.with_image(F.col("v"), "i"), "COPY x y\n") == "COPY x y\n"
    assert one(spark, render.filled(F.col("v"), {"a": F.lit("1")}), "{a} {b}") == "1 {b}"


def test_suffixes(spark):
    from pathlib import PurePosixPath

    from patchloom.functions import text

    paths = ["a.py", "x/a.b.py", ".py", "x/.py", "a", "a.", "..py", "x.d/a", "a.py.", ".a.b", "", None]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in paths], "p string").coalesce(1).select(text.suffix(F.col("p"))).collect()]
    assert got == [None if p is None else "" if p.endswith(".") else PurePosixPath(p).suffix for p in paths]


def test_lines_of_files_carry_headers(spark):
    """Every line has the header that a window over all lines carries to it, without a sort or a shuffle."""
    import random

    from patchloom.functions import text
    from patchloom.operators import relational

    draw = random.Random(5)
    pieces = ["diff --git a/x b/x", "diff --git a/y é b/z b/z", "diff --git odd", " diff --git a/q b/q", "--- a/x", "+++ b/x", "@@ -1 +1 @@", "-a", "+b", "", "\u00e9"]
    texts = [None, "", "\n", *("".join(draw.choice(pieces) + draw.choice(["\n", "\r\n", "\x0b", "\u2028", "\x85"]) for _ in range(draw.randint(0, 12))) + draw.choice(["", "-z"]) for _ in range(2500))]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, patch string").coalesce(2)
    got = patches.lines_of_files(df, "patch")
    assert not any(x in got._jdf.queryExecution().executedPlan().toString() for x in ("Exchange", "Sort", "Window"))
    lines = df.select("k", F.posexplode(text.split_lines(F.col("patch"))).alias("pos", "line"))
    header = F.when(F.startswith("line", F.lit("diff --git ")), F.regexp_extract("line", "^diff --git a/(.*?) b/", 1))
    want = relational.carried_header(lines, header, ["k"], "pos", "path")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(got.columns).collect()))
