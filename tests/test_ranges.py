"""Scans by ranges and what is built on them, with hot groups and against plain Python."""

import random
import time

import pytest
from pyspark.sql import functions as F

from patchloom.operators import ranges, relational


@pytest.fixture(autouse=True)
def _as_dealt(spark):
    """Small ranges stay apart, as large ones would."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def plain(rows, op, by):
    out, held = [], {}
    for key, at, v in sorted(rows, key=lambda r: ((r[0] is not None, r[0] or "") if by else 0, r[1])):
        k = key if by else 0
        if v is not None:
            old = held.get(k)
            held[k] = v if old is None or op == "last" else {"sum": lambda: old + v, "min": lambda: min(old, v), "max": lambda: max(old, v)}[op]()  # noqa: B023
        out.append((key, at, held.get(k)))
    return out


@pytest.mark.parametrize("by", [[], ["k"]])
@pytest.mark.parametrize("op", ranges.OPS)
def test_scans_against_a_loop(spark, op, by):
    draw = random.Random(len(by) + len(op))
    rows = [(draw.choice(["hot"] * 8 + ["a", "b", None]), i, draw.choice([None, draw.randrange(-50, 50)])) for i in range(700)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, at int, v bigint").repartition(6)
    got = ranges.scan(df, ["at"], {"s": (op, "v")}, by).select("k", "at", "s").collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, plain(rows, op, by)))


def test_a_scan_keeps_other_types_and_names(spark):
    df = spark.createDataFrame([(1, "x", None), (2, None, 2.5), (3, "z", 1.5)], "part int, one string, had double")
    got = ranges.scan(df, ["part"], {"one": ("last", "one"), "low": ("min", "had")}).orderBy("part").collect()
    assert [tuple(r) for r in got] == [(1, None, "x", None), (2, 2.5, "x", 2.5), (3, 1.5, "z", 1.5)]
    assert ranges.scan(df.limit(0), ["part"], {"low": ("min", "had")}).count() == 0
    with pytest.raises(ValueError, match="unknown"):
        ranges.scan(df, ["part"], {"x": ("mean", "had")})


def test_a_hot_group_is_numbered_by_several_tasks(spark):
    df = spark.range(200_000).select(F.when(F.col("id") % 10 > 0, "").otherwise(F.col("id").cast("string")).alias("v"), "id")
    got = ranges.numbered(df, ["id"], "n", ["v"])
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * sum(sizes) / len(sizes) and len(sizes) > 1
    assert got.filter("v = ''").agg(F.max("n"), F.countDistinct("n")).first() == (180_000, 180_000)


def test_running_ratio_of_all_rows(spark):
    n = 2_000_000
    df = spark.range(n).select("id", (F.lit(n) - F.col("id") % 1000 * 1000 + F.col("id") % 7).alias("lines"))
    got = relational.running_least_ratio(df, "lines", "id", 8, 10_000_000)
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
    term = F.round(F.lit(10_000_000.0) / F.col("lines"), 1)
    least = df.filter(f"id < {n // 2}").agg(F.least(F.lit(8.0), F.min(term))).first()[0]
    assert got.filter(f"id = {n // 2 - 1}").first()["ratio"] == least
    assert got.count() == n


def test_bag_difference_of_mostly_blank_lines(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 10 > 0, "").otherwise(F.concat(F.lit("l"), F.col("id") % 50)).alias("v"))
    right = spark.range(100_000).select(F.col("id").alias("had"), F.when(F.col("id") % 10 > 0, "").otherwise(F.concat(F.lit("l"), F.col("id") % 50)).alias("v"))
    got = relational.bag_difference(left, right, [], "v", "had")
    assert got.columns == ["had", "v"]
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * sum(sizes) / len(sizes)
    have, want = {}, []
    for r in left.collect():
        have[r.v] = have.get(r.v, 0) + 1
    for r in right.orderBy("had").collect():
        if have.get(r.v, 0):
            have[r.v] -= 1
        else:
            want.append(r.had)
    assert [r.had for r in got.orderBy("had").collect()] == want


def test_bag_difference_of_nulls(spark):
    left, right = (spark.createDataFrame([(None, 1, "x"), ("i", 2, None), ("i", 3, "x")], "i string, n int, v string") for _ in range(2))
    assert [r.n for r in relational.bag_difference(left, right, ["i"], "v", "n").orderBy("n").collect()] == [1, 2]


def test_spans_with_points_against_brute_force(spark):
    draw = random.Random(3)
    spans = [(draw.choice("fg"), a := draw.randrange(300), draw.choice([None, a + draw.randrange(-2, 12)])) for _ in range(300)] + [(None, 1, 9), ("f", None, 9)]
    points = [(draw.choice(["f", "g", None]), draw.choice([None, draw.randrange(300)])) for _ in range(60)]
    got = relational.interval_semi_join(spark.createDataFrame(spans, "at string, seen int, kind int"), spark.createDataFrame(points, "at string, p int"), ["at"], "seen", "kind", "p")
    want = [s for s in spans if None not in s and any(k == s[0] and p is not None and s[1] <= p <= s[2] for k, p in points)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_spans_of_one_long_file(spark):
    lines = spark.range(1_000_000).select(F.lit("f").alias("f"), (F.col("id") * 3).alias("n"))
    spans = spark.range(100_000).select(F.lit("f").alias("f"), (F.col("id") * 30 + 1).alias("s"), (F.col("id") * 30 + 1 + F.col("id") % 3).alias("e"))
    began = time.perf_counter()
    assert relational.interval_semi_join(spans, lines, ["f"], "s", "e", "n").count() == 33_333
    assert time.perf_counter() - began < 60


def test_prefixes_by_cuts(spark):
    values = spark.createDataFrame([("p", "abcdef"), ("p", "ab"), ("p", "zz"), ("q", "abc"), ("p", None), (None, "abc"), ("p", "abcdef"), ("q", "")], "key string, text string")
    prefixes = spark.createDataFrame([("p", "abc"), ("p", "abcd"), ("p", "y"), ("q", "b"), ("q", ""), (None, "a"), ("p", None)], "key string, x string")
    got = relational.prefix_match(values, prefixes, "key", "text", "x", "hit")
    assert sorted((r["key"] or "", r["text"] or "", r["hit"]) for r in got.collect()) == sorted([("p", "abcdef", True), ("p", "abcdef", True), ("p", "ab", False), ("p", "zz", False), ("q", "abc", True), ("q", "", True), ("p", "", False), ("", "abc", False)])
    many = spark.range(200_000).select(F.lit("p").alias("key"), F.concat(F.lit("c"), F.col("id") * 2).alias("x"))
    own = spark.range(1000).select(F.lit("p").alias("key"), F.concat(F.lit("c"), F.lit(1_000_001 // 5) + F.col("id"), F.lit("/x")).alias("text"))
    assert relational.prefix_match(own, many, "key", "text", "x", "hit").filter("hit").count() > 0
