"""Pattern sets, templates, row numbers of files and ends of texts."""

import json
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from patchloom.functions import logs, patches, patterns, templates, text
from patchloom.operators import relational
from patchloom.plans import evaluation
from patchloom.schemas import STARTUP_ERROR_PATTERNS, SYMBOL_ERROR_PATTERNS
from patchloom.sources import readers

MARKS = ["error during collection", "errors during collection\n", "ImportError while loading", "Test-module import failure", "Creating test database for alias 'default' ...\nTraceback", "IndentationError: unexpected indent\n", "Traceback", "compilemessages\r\nTraceback", "EDestroying test database for alias", "E\n", "TypeError:", "AttributeError: no attribute", "pydantic.x.ValidationError:", "NameError: name 'x'", "x" * 40, "\n", "INTERNALERROR>", "Applying a OK\nTraceback"]


def test_literals_are_in_every_match():
    draw = random.Random(4)
    known = [*STARTUP_ERROR_PATTERNS, *SYMBOL_ERROR_PATTERNS]
    seen = set()
    for _ in range(4000):
        log = "".join(draw.choice(MARKS) + draw.choice(["", "\n", " "]) for _ in range(draw.randrange(6)))
        for i, p in enumerate(known):
            if m := re.search(p, log, re.MULTILINE):
                seen.add(i)
                assert patterns.literal_of(p) in m[0]
    assert len(seen) > 12
    assert [patterns.literal_of(p) for p in ("ab|cd", "colou?r", r"a\.b+", "(xyz)+q", "[abc]def{2}g", r"\d+")] == ["", "colo", "a.b", "q", "de", ""]


def test_one_pass_finds_what_each_pattern_does(spark):
    draw = random.Random(7)
    texts = ["".join(draw.choice(MARKS) + draw.choice(["", "\n", " "]) for _ in range(draw.randrange(6))) for _ in range(800)] + ["", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: (r["s"], r["n"]) for r in df.select("i", logs.run_status(F.col("t"), F.lit(False)).alias("s"), logs.symbol_errors(F.col("t")).alias("n")).collect()}
    for i, t in enumerate(texts):
        bad = t is not None and any(re.search(p, t, re.MULTILINE) for p in STARTUP_ERROR_PATTERNS)
        count = None if t is None else sum(len(re.findall(p, t, re.MULTILINE)) for p in SYMBOL_ERROR_PATTERNS)
        assert got[i] == ("startup_error" if bad else "completion", count)
    plan = df.select(logs.run_status(F.col("t"), F.lit(False)), logs.symbol_errors(F.col("t")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "pythonUDF1" not in plan


def test_long_logs_are_passed_once(spark):
    one = logs.java_pattern
    log = "".join(f"tests/test_{i}.py::test_case PASSED [ {i % 100}%] some words of a log line\n" for i in range(15_000))
    df = spark.createDataFrame([(i, log) for i in range(64)], "i int, t string").repartition(4).cache()
    df.count()
    failed = F.lit(False)
    for p in STARTUP_ERROR_PATTERNS:
        failed = failed | F.regexp_like("t", F.lit(one(p)))
    total = sum((F.regexp_count("t", F.lit(one(p))) for p in SYMBOL_ERROR_PATTERNS), F.lit(0))
    took = []
    for columns in ([failed, total], [logs.run_status(F.col("t"), F.lit(False)), logs.symbol_errors(F.col("t"))]):
        best = 1e9
        for _ in range(2):
            began = time.perf_counter()
            df.select(*columns).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - began)
        took.append(best)
    assert took[1] < took[0]


def test_templates_as_columns(spark):
    df = spark.createDataFrame([(["a", "b"], "x", [("i", ["p", "q"]), ("j", [])], None), ([], "", [], True), (None, None, None, False)], "files array<string>, name string, nested array<struct<id:string,own:array<string>>>, yes boolean").coalesce(1)
    values = {c: F.col(c) for c in df.columns}
    render = lambda t: [r[0] for r in df.select(templates.rendered(t, values)).collect()]
    assert render("<T>\n{% for f in files -%}\n{{ f }}\n{% endfor -%}\n</T>\n") == ["<T>\na\nb\n</T>", "<T>\n</T>", "<T>\n</T>"]
    assert render('{ {% for f in files -%}\n"{{ f }}": "p"{{ "," if not loop.last }}\n{% endfor %}}') == ['{ "a": "p",\n"b": "p"\n}', "{ }", "{ }"]
    assert render("{{ name }}|{% if name %}yes{% else %}no{% endif %}") == ["x|yes", "|no", "None|no"]
    assert render("{% for n in nested %}{{ loop.index }}{{ n.id }}:{% for o in n.own %}{{ n.id }}{{ o }} {% endfor %};{% endfor %}{% if yes %}!{% endif %}") == ["1i:ip iq ;2j:;", "!", ""]
    for bad in ("{{ other }}", "{% for x in files %}", "{% while x %}", "{% for x of files %}{% endfor %}"):
        with pytest.raises(ValueError, match="template|no endfor|unknown|not a loop"):
            render(bad)


def test_templates_of_many_rows(spark):
    rows = [([f"s{j}" for j in range(i % 4)],) for i in range(50)]
    template = "List:\n{% for status in statuses -%}\n- {{ status }}\n{% endfor %}\nend"
    got = [r[0] for r in spark.createDataFrame(rows, "statuses array<string>").coalesce(1).select(templates.rendered(template, {"statuses": F.col("statuses")})).collect()]
    assert got == ["List:\n" + "".join(f"- {s}\n" for s in own) + "\nend" for (own,) in rows]


def test_row_numbers_of_split_files(spark, tmp_path):
    for name, n in (("a", 5000), ("b", 3), ("c", 0), ("d", 2000)):
        (tmp_path / f"{name}.json").write_text("".join(json.dumps({"name": name, "i": i, "path": "x" * (i % 90)}) + "\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = readers.json_lines(spark, str(tmp_path), "name string, i int, path string")
        assert lines.rdd.getNumPartitions() > 10
        got = readers.with_row_number(lines)
        assert got.columns == ["name", "i", "path", "row"]
        assert got.filter("row <> i").count() == 0 and got.count() == 7003
        assert [r["i"] for r in relational.page(got.filter("name = 'a'"), "row", 2500, 3).collect()] == [2500, 2501, 2502]
        assert sorted(r["i"] for r in relational.keep_first(got, "name", ["row"]).collect()) == [0, 0, 0]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_tails_are_those_of_the_whole_text():
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    tokenizer = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    draw = random.Random(2)
    words = ["alpha", "  beta", "\n", "\n\n  gamma", "1999", "don't", "é", "\t", "x" * 30]
    for size in (0, 5, 3000, 30_000):
        log = " ".join(draw.choice(words) for _ in range(size))
        offsets = tokenizer.encode(log, add_special_tokens=False).offsets
        for n in (0, 1, 50, 3000):
            want = "" if not n else log if len(offsets) <= n else log[offsets[-n][0] :]
            assert text._tail(log, tokenizer, n) == want


def test_added_text_of_a_long_patch(spark):
    head = "diff --git a/x/sel.json b/x/sel.json\n--- a/x/sel.json\n+++ b/x/sel.json\n@@ -0,0 +1 @@\n"
    other = "diff --git a/y.py b/y.py\n--- a/y.py\n+++ b/y.py\n@@ -0,0 +1 @@\n+no\n"
    many = head + "".join(f"+line {i}\n" for i in range(60_000)) + other
    began = time.perf_counter()
    got = [r["text"] for r in patches.added_text(spark.createDataFrame([(many,), (None,), ("",), (other,)], "p string").coalesce(1), "p", "sel.json").collect()]
    assert got == ["\n".join(f"line {i}" for i in range(60_000)), "", "", ""] and time.perf_counter() - began < 20


def test_repeated_runs_take_the_last_or_fail(spark):
    run = "instance_id string, run_name string, logs string, timed_out boolean"
    specs = spark.createDataFrame([("i", {"FAILED": r"(\d+) failed"}, 0), ("i", {"FAILED": r"(\d+) broken"}, 1)], "instance_id string, logs_parser map<string,string>, _pos int")
    twice = spark.createDataFrame([("i", "func", "5 failed", False, 2), ("i", "func", "3 broken", False, 3)], run + ", _pos int")
    assert [r["failures"] for r in evaluation.run_failures(twice, specs).collect()] == [3]
    with pytest.raises(Exception, match="repeated instance_id"):
        evaluation.run_failures(twice, specs.drop("_pos")).collect()
    with pytest.raises(Exception, match="repeated instance_id, run_name"):
        evaluation.run_failures(twice.drop("_pos"), specs).collect()


def test_names_that_joins_use_inside_do_not_clash(spark):
    old = spark.createDataFrame([("a", 1, 5)], "k string, here int, new int")
    new = spark.createDataFrame([("a", 2, 6), ("b", 3, 7)], "k string, here int, new int")
    assert sorted(tuple(r) for r in relational.upsert(old, new, "k", ["here"]).collect()) == [("a", 2, 5), ("b", 3, 7)]
    assert [tuple(r) for r in relational.update_matched(old, new, "k", "new").collect()] == [("a", 1, 6)]
    assert relational.strict_lookup(old.select("k", F.col("here").alias("found")), new.select("k", "new"), "k").columns == ["k", "found", "new"]
    assert [tuple(r) for r in relational.keep_first(old.withColumnRenamed("here", "row"), "k", ["row"]).collect()] == [("a", 1, 5)]
