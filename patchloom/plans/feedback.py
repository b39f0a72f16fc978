"""Feedback from security tests: what their logs have beyond the functional run's."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchloom.functions.text import split_lines
from patchloom.operators import relational


def security_feedback(reports: DataFrame, run_logs: DataFrame) -> DataFrame:
    """(instance_id, lines) of instances whose functional run passes and whose security run fails.

    The lines are the security log's, in order, beyond as many equal lines as
    the functional log has.
    """
    asked = reports.filter(F.col("func.pass") & ~F.col("sec.pass")).select("instance_id")
    lines = run_logs.join(asked, "instance_id", "left_semi").select("instance_id", "run_name", F.posexplode(split_lines(F.col("logs"))).alias("pos", "line"))
    extra = relational.bag_difference(lines.filter("run_name = 'func'"), lines.filter("run_name = 'sec'"), ["instance_id"], "line", "pos")
    ordered = extra.groupBy("instance_id").agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("x"))
    return asked.join(ordered, "instance_id", "left").select("instance_id", F.coalesce(F.transform("x", lambda x: x["line"]), F.array().cast("array<string>")).alias("lines"))
