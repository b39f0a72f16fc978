"""Logs of test runs that arrive in chunks, with a deadline for each run.

A chunk is (instance_id, run_name, seq, kind, data): ``log`` has a piece of the
output, ``end`` closes the run, ``error`` closes it with a message.  A run that
is not closed within the deadline after its first chunk is closed with what has
come until then, as timed out.  Pieces are joined by ``seq`` and read as UTF-8
only when whole, since a piece may end within a character.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

CHUNKS = "instance_id string, run_name string, seq bigint, kind string, data binary"
RUNS = "instance_id string, run_name string, logs string, timed_out boolean, error string, fault string, chunks bigint"
#: A test run's time in milliseconds, and how long a closed run is remembered, so that late chunks do not open it again.
DEADLINE = 1_800_000
REMEMBERED = 86_400_000

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
NOT_TEXT = "not UTF-8"


def chunk_stream(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of chunks, as files arrive; ``data`` is in base 64."""
    return spark.readStream.schema(CHUNKS).json(path)


class RunLogs(StatefulProcessor):
    """Keeps the chunks of an open run, and closes it by its end, its first error or its timer."""

    def __init__(self, deadline: int, remembered: int) -> None:
        self.deadline, self.remembered = deadline, remembered

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pieces = handle.getListState("pieces", "seq bigint, data binary")
        self.due = handle.getValueState("due", "at bigint")
        self.closed = handle.getValueState("closed", "at bigint", ttlDurationMs=self.remembered)

    def _close(self, key: tuple, now: int, new: list[tuple], timed_out: bool, error: str | None) -> Row:
        held = [(p[0], bytes(p[1])) for p in self.pieces.get()] if self.pieces.exists() else []
        pieces = sorted([*held, *new], key=lambda p: p[0])
        logs, fault = b"".join(p[1] for p in pieces), None
        try:
            logs = logs.decode()
        except UnicodeDecodeError:
            logs, fault = None, NOT_TEXT
        self.pieces.clear()
        self.due.clear()
        self.closed.update((now,))
        return Row(instance_id=key[0], run_name=key[1], logs=logs, timed_out=timed_out, error=error, fault=fault, chunks=len(pieces))

    def handleInputRows(self, key: tuple, rows: Iterable[Row], timerValues) -> Iterator[Row]:
        if self.closed.exists():
            return
        now = timerValues.getCurrentProcessingTimeInMs()
        if not self.due.exists():
            self.due.update((now + self.deadline,))
            self.handle.registerTimer(now + self.deadline)
        new = []
        for row in sorted(rows, key=lambda r: r["seq"]):
            if row["kind"] != "log":
                self.handle.deleteTimer(self.due.get()[0])
                error = bytes(row["data"] or b"").decode(errors="replace") if row["kind"] == "error" else None
                yield self._close(key, now, new, False, error)
                return
            new.append((row["seq"], bytes(row["data"] or b"")))
        self.pieces.appendList(new)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.due.exists():
            yield self._close(key, expiredTimerInfo.getExpiryTimeInMs(), [], True, None)


def finished_runs(chunks: DataFrame, deadline: int = DEADLINE, remembered: int = REMEMBERED) -> DataFrame:
    """``RUNS`` of a stream of chunks, each once, when it ends, fails or its time is over.

    Needs the state store ``STORE``, which ``use_store`` sets for a session.  A
    run's timer is checked with each batch, and batches go on without new chunks, so
    the trigger is one of processing time; one that ends when no chunks are left
    would not end.  Chunks of other kinds close a run like ``end``; those without
    data are empty; chunks of a closed run are dropped.  Of chunks that arrive in
    one batch, those before the closing one by ``seq`` count.
    """
    keyed = chunks.filter("instance_id IS NOT NULL AND run_name IS NOT NULL AND seq IS NOT NULL").groupBy("instance_id", "run_name")
    return keyed.transformWithState(RunLogs(deadline, remembered), RUNS, "Update", "ProcessingTime")


def use_store(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    return spark


def runs_of_table(chunks: DataFrame, now: Column, deadline: int = DEADLINE) -> DataFrame:
    """What ``finished_runs`` gives for chunks that are a table with ``at``, the time of arrival, as seen at ``now``.

    A run is closed by its first chunk of another kind than ``log`` that arrives
    within the deadline; of one that has none and is due, all chunks of that time
    count.  Open runs are left out.
    """
    key = ["instance_id", "run_name"]
    own = chunks.filter("instance_id IS NOT NULL AND run_name IS NOT NULL AND seq IS NOT NULL")
    millis = lambda c: F.unix_millis(F.col(c).cast("timestamp"))
    begun = own.groupBy(*key).agg(F.min(millis("at")).alias("begun"))
    timely = own.withColumn("ms", millis("at")).join(begun, key).filter(F.col("ms") < F.col("begun") + deadline)
    is_log = F.col("kind") == "log"
    place = F.struct("ms", "seq")
    closing = timely.groupBy(*key).agg(F.min(F.when(~is_log, place)).alias("closed"), F.min_by(F.struct("kind", "data"), F.when(~is_log, place)).alias("last"), F.first("begun").alias("begun"))
    due = F.unix_millis(now.cast("timestamp")) >= F.col("begun") + deadline
    over = closing.filter(F.col("closed").isNotNull() | due)
    pieces = timely.filter(is_log).join(over.select(*key, "closed"), key).filter(F.col("closed").isNull() | (place < F.col("closed")))
    joined = pieces.groupBy(*key).agg(F.expr("listagg(coalesce(data, X'')) WITHIN GROUP (ORDER BY seq)").alias("bytes"), F.count("*").alias("chunks"))
    text = F.col("bytes").cast("string")
    whole = F.is_valid_utf8(text)
    out = over.join(joined, key, "left").withColumn("bytes", F.coalesce("bytes", F.lit(b"")))
    error = F.when(F.col("last.kind") == "error", F.coalesce(F.make_valid_utf8(F.col("last.data").cast("string")), F.lit("")))
    return out.select(*key, F.when(whole, text).alias("logs"), F.col("closed").isNull().alias("timed_out"), error.alias("error"), F.when(~whole, NOT_TEXT).alias("fault"), F.coalesce("chunks", F.lit(0)).cast("bigint").alias("chunks"))
