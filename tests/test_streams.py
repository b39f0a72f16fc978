"""Chunked logs with deadlines, and tables that batches are merged into."""

import base64
import glob
import json
import time

import pytest
from pyspark.sql import functions as F

from patchloom.sources.keyed_table import KeyedTable
from patchloom.streaming import reports, runs


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    lines = [{"instance_id": i, "run_name": r, "seq": n, "kind": k, "data": None if d is None else base64.b64encode(d).decode()} for i, r, n, k, d in rows]
    (folder / name).write_text("\n".join(map(json.dumps, lines)))


@pytest.fixture
def store(spark):
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def follow(spark, tmp_path, deadline, n):
    """Runs the stream from its checkpoint until ``n`` rows have come out."""
    got = []

    def keep(batch, _):
        got.extend(tuple(r) for r in batch.collect())

    found = runs.finished_runs(runs.chunk_stream(runs.use_store(spark), str(tmp_path / "in")), deadline)
    query = found.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "check")).trigger(processingTime="500 milliseconds").start()
    until = time.time() + 90
    while len(got) < n and time.time() < until and query.isActive:
        time.sleep(0.2)
    query.stop()
    return sorted(got, key=str)


def test_runs_end_fail_or_time_out_over_a_restart(spark, store, tmp_path):
    half = "né".encode()
    first = [("a", "func", 0, "log", b"one "), ("a", "func", 2, "end", None), ("a", "func", 1, "log", b"two"), ("b", "func", 0, "log", half[:2]), ("c", "func", 0, "log", b"step 1\n"), ("c", "func", 1, "error", b"no such image"), ("c", "func", 2, "log", b"never"), ("d", "sec", 0, "log", b"\xff"), (None, "sec", 0, "log", b"x")]
    put(tmp_path / "in", "1.json", first)
    deadline = 12000
    assert follow(spark, tmp_path, deadline, 2) == [("a", "func", "one two", False, None, None, 2), ("c", "func", "step 1\n", False, "no such image", None, 1)]
    # The stream is started again from its checkpoint, which has the open runs and their timers.
    put(tmp_path / "in", "2.json", [("b", "func", 1, "log", half[2:]), ("a", "func", 3, "log", b"late"), ("e", "func", 0, "end", None)])
    timed_out = [("b", "func", "né", True, None, None, 2), ("d", "sec", None, True, None, runs.NOT_TEXT, 1)]
    assert follow(spark, tmp_path, deadline, 3) == sorted([*timed_out, ("e", "func", "", False, None, None, 0)], key=str)
    # Late chunks of closed runs open nothing.
    put(tmp_path / "in", "3.json", [("c", "func", 3, "log", b"late"), ("b", "func", 3, "end", None), ("f", "func", 0, "end", None)])
    assert follow(spark, tmp_path, deadline, 1) == [("f", "func", "", False, None, None, 0)]
    # The same chunks as a table with their times of arrival.
    rows = [(*r, 0) for r in first] + [("b", "func", 1, "log", half[2:], 1000), ("a", "func", 3, "log", b"late", 1000), ("e", "func", 0, "end", None, 1000), ("g", "func", 0, "log", b"new", 16000), ("c", "func", 3, "log", b"late", 16000)]
    table = spark.createDataFrame(rows, runs.CHUNKS + ", ms long").withColumn("at", F.timestamp_millis("ms"))
    twin = runs.runs_of_table(table, F.timestamp_millis(F.lit(16000)), deadline).collect()
    whole = [("a", "func", "one two", False, None, None, 2), ("b", "func", "né", True, None, None, 2), ("c", "func", "step 1\n", False, "no such image", None, 1), ("d", "sec", None, True, None, runs.NOT_TEXT, 1), ("e", "func", "", False, None, None, 0)]
    assert sorted((tuple(r) for r in twin), key=str) == sorted(whole, key=str)


ROWS = "instance_id string, v int, part string"


def test_merge_keeps_the_last_row_of_each_key(spark, tmp_path):
    table = KeyedTable.create(spark, str(tmp_path / "t"), ROWS, "instance_id", 8)
    assert table.exists() and not KeyedTable(spark, str(tmp_path / "none")).exists() and table.read().count() == 0
    with pytest.raises(Exception, match="exist"):
        KeyedTable.create(spark, table.path, ROWS, "instance_id")
    frame = lambda rows: spark.createDataFrame(rows, ROWS + ", at int")
    assert table.merge(frame([(f"i{n}", n, "p", 0) for n in range(40)] + [("i3", 33, "q", 1)]), ["at"]) == 1
    assert {tuple(r) for r in table.read().collect()} == {(f"i{n}", n, "p") for n in range(40) if n != 3} | {("i3", 33, "q")}
    files = lambda own: {b: sorted(glob.glob(f"{table.path}/{f}/*.parquet")) for b, f in own.folders.items()}
    before = files(table.manifest())
    assert table.merge(frame([("i5", 50, None, 0), ("new", 1, "n", 0)]), ["at"], columns=["v"]) == 2
    after = files(table.manifest())
    touched = {b for b in after if before.get(b) != after[b]}
    assert 1 <= len(touched) <= 2 and all(before[b] == after[b] for b in set(after) - touched)
    assert {tuple(r) for r in table.read().filter("instance_id IN ('i5', 'new')").collect()} == {("i5", 50, "p"), ("new", 1, "n")}
    assert table.read(1).filter("instance_id = 'new'").count() == 0 and table.read().count() == 41
    assert table.merge(frame([]), ["at"]) == 2


def test_a_failed_merge_is_not_seen(spark, tmp_path):
    table = KeyedTable.create(spark, str(tmp_path / "t"), ROWS, "instance_id", 4)
    table.merge(spark.createDataFrame([("a", 1, "p")], ROWS))
    with pytest.raises(Exception, match="repeated key"):
        table.merge(spark.createDataFrame([("a", 2, "p"), ("a", 3, "p")], ROWS))
    with pytest.raises(Exception, match="without a key"):
        table.merge(spark.createDataFrame([(None, 2, "p")], ROWS))
    with pytest.raises(ValueError, match="lacks"):
        table.merge(spark.createDataFrame([("a", 2)], "instance_id string, other int"))
    publish = table._publish
    table._publish = lambda manifest: 1 / 0
    with pytest.raises(ZeroDivisionError):
        table.merge(spark.createDataFrame([("a", 9, "p"), ("b", 9, "p")], ROWS))
    table._publish = publish
    assert [tuple(r) for r in table.read().collect()] == [("a", 1, "p")] and table.manifest().version == 1
    # Two writers of one version: the second fails.
    stale = table.manifest()
    table.merge(spark.createDataFrame([("b", 2, "p")], ROWS))
    with pytest.raises(Exception, match="exist"):
        table._publish(stale._replace(version=2))
    assert table.read().count() == 2


def test_a_stream_merges_each_batch_once(spark, tmp_path):
    table = KeyedTable.create(spark, str(tmp_path / "t"), ROWS, "instance_id", 4)
    (tmp_path / "in").mkdir()
    rows = lambda name, rows: (tmp_path / "in" / name).write_text("\n".join(json.dumps({"instance_id": i, "v": v, "part": "p"}) for i, v in rows))
    run = lambda check: reports.merge_table(reports.report_stream(spark, str(tmp_path / "in"), ROWS), table, str(tmp_path / check), "results", ["v"]).awaitTermination(120)
    rows("1.json", [("a", 1), ("b", 2), ("a", 3)])
    assert run("check")
    rows("2.json", [("b", 5), ("c", 1)])
    assert run("check")
    whole = {("a", 3, "p"), ("b", 5, "p"), ("c", 1, "p")}
    assert {tuple(r) for r in table.read().collect()} == whole and table.manifest().batches == {"results": 1}
    # The stream has lost its checkpoint and replays what the table has: its first batches are known.
    version = table.manifest().version
    assert run("other")
    assert table.manifest().version == version and {tuple(r) for r in table.read().collect()} == whole
