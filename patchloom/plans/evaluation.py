"""Scoring of predictions as one plan over predictions, dataset, environment specifications and run logs."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.functions import logs, patches
from patchloom.operators import relational, scoring
from patchloom.schemas import FAILURE_STATUSES

RUNS = ["func", "sec"]
SETUP_RUNS = ["base", "rollback", "sec_patch", "sec_test", "task"]


def run_failures(run_logs: DataFrame, specs: DataFrame, order: str = "_pos") -> DataFrame:
    """Per instance and run: status, failures, symbol errors and ``fault``.

    Of an instance's repeated specifications, and of its runs of one name, the
    last by ``order`` counts; in a table without that column they are an error.

    The patterns of an instance come from its specification, in Python's
    dialect.  Logs are classified where they are read and only then joined.
    Patterns are tried by each worker's own regular expressions, so one that
    does not compile, or whose group is no number, is that row's ``fault`` and
    not the query's.
    """
    single = relational.one_of_each(run_logs, ["instance_id", "run_name"], order)
    status = single.withColumn("status", logs.run_status(F.col("logs"), F.col("timed_out"))).withColumn("symbols", logs.symbol_errors(F.col("logs")))
    own = relational.one_of_each(specs, ["instance_id"], order).select("instance_id", "logs_parser")
    joined = status.join(own, "instance_id").withColumn("parsed", logs.parsed_by_rows(F.col("logs"), F.col("logs_parser")))
    done = F.col("status") == "completion"
    failures = sum((F.coalesce(F.try_element_at("parsed.counts", F.lit(s)), F.lit(0)) for s in FAILURE_STATUSES), F.lit(0))
    return joined.select("instance_id", "run_name", "status", failures.alias("failures"), "symbols", F.when(done, F.col("parsed.fault")).alias("fault"))


def pivoted_runs(runs: DataFrame, names: list[str]) -> DataFrame:
    """One row per instance with a struct column for each run, of which there is one of each name."""
    return runs.groupBy("instance_id").pivot("run_name", names).agg(F.first(F.struct("status", "failures", "symbols", "fault")))


def filtered_predictions(predictions: DataFrame, dataset: DataFrame, order: str = "_pos") -> DataFrame:
    """What is run: the last prediction of each instance of the dataset, without the blocks of files that its test patch touches."""
    chosen = relational.last_wins(predictions, "instance_id", [order])
    known = dataset.select("instance_id", patches.touched_files(F.coalesce("test_patch", F.lit(""))).alias("__tests"))
    return patches.filtered_patch(chosen.join(known, "instance_id"), "model_patch", "__tests", exclude=True).drop("__tests", "__first")


def run_requests(predictions: DataFrame, dataset: DataFrame, order: str = "_pos", finished: DataFrame | None = None, force: bool = False) -> DataFrame:
    """(instance_id, run_name, patches): what each run applies, for the predicted instances without a finished report, or all with ``force``.

    Both runs apply the task's patch and the prediction without the files of the
    test patch; the run for security also applies the test patch, in between.
    """
    known = relational.one_of_each(dataset, ["instance_id"], order)
    own = filtered_predictions(predictions, known, order).select("instance_id", F.col("filtered_patch").alias("own"))
    if finished is not None and not force:
        own = relational.pending(own, finished, "instance_id")
    joined = own.join(known.select("instance_id", "task_patch", "test_patch"), "instance_id")
    runs = [F.struct(F.lit("func").alias("run_name"), F.array("task_patch", "own").alias("patches")), F.struct(F.lit("sec").alias("run_name"), F.array("task_patch", "test_patch", "own").alias("patches"))]
    return joined.select("instance_id", F.inline(F.array(*runs)))


class Evaluation(NamedTuple):
    reports: DataFrame
    skipped: DataFrame


def evaluate(predictions: DataFrame, dataset: DataFrame, run_logs: DataFrame, specs: DataFrame, order: str = "_pos", finished: DataFrame | None = None, selection: bool = False, force: bool = False) -> Evaluation:
    """Reports, one row per predicted instance of the dataset, and the instances ``skipped``, with their ``fault``.

    The last of an instance's repeated predictions wins, and of its dataset
    rows, specifications and runs, if they have the column ``order``; if not,
    repeated ones are an error.
    Reports that ``finished`` has are taken over, unless ``force``.  A run
    without a log could not be built, which is a patch error.  An instance
    without a specification, or with a pattern or a number that cannot be read,
    is skipped.  With ``selection`` the weaknesses that a prediction names are
    compared to the dataset's.
    """
    chosen = relational.last_wins(predictions, "instance_id", [order]).select("instance_id", F.col("model_name_or_path").alias("model"), "model_patch")
    columns = ["instance_id", "expected_failures", *(["cwe_ids"] if selection else [])]
    known = relational.one_of_each(dataset, ["instance_id"], order).select(*columns)
    asked = chosen.join(known, "instance_id")
    done = None
    if finished is not None and not force:
        done = finished.join(asked.select("instance_id"), "instance_id", "left_semi")
        asked = relational.pending(asked, finished, "instance_id")
    specified = specs.select("instance_id").distinct().withColumn("__spec", F.lit(True))
    runs = pivoted_runs(run_failures(run_logs.filter(F.col("run_name").isin(RUNS)), specs, order), RUNS)
    joined = asked.join(specified, "instance_id", "left").join(runs, "instance_id", "left")
    lost = F.lit("model_patch_error")
    report = scoring.outcome(F.coalesce("func.status", lost), F.coalesce("func.failures", F.lit(0)), F.coalesce("sec.status", lost), F.coalesce("sec.failures", F.lit(0)), F.col("expected_failures"))
    fault = F.when(F.col("__spec").isNull(), "no specification").otherwise(F.coalesce("func.fault", "sec.fault"))
    joined = joined.withColumn("fault", fault)
    wanted = ["instance_id", "model", "r.func", "r.sec"]
    good = joined.filter("fault IS NULL").withColumn("r", report)
    if selection:
        named = patches.added_text(good, "model_patch", "selected_cwes.json", out="__named")
        good = named.withColumn("cwes_selection", scoring.selection_quality_of_text(F.col("__named"), F.col("cwe_ids")))
        wanted.append("cwes_selection")
    reports = good.select(*wanted)
    if done is not None:
        reports = reports.unionByName(done.select(*reports.columns), allowMissingColumns=True)
    return Evaluation(reports, joined.filter("fault IS NOT NULL").select("instance_id", "model", F.lit("internal_error").alias("status"), "fault"))


def validated_tasks(run_logs: DataFrame, specs: DataFrame) -> DataFrame:
    """The break check of each instance's five runs."""
    runs = pivoted_runs(run_failures(run_logs, specs), SETUP_RUNS)
    f = {n: F.col(f"{n}.failures") for n in SETUP_RUNS}
    done = {n: F.col(f"{n}.status") == "completion" for n in ("sec_test", "task")}
    check = scoring.break_check(*(f[n] for n in SETUP_RUNS), done["sec_test"], done["task"], F.col("sec_test.symbols"), F.col("rollback.symbols"))
    return runs.select("instance_id", check.alias("check")).select("instance_id", "check.*")


def progress(results: DataFrame, ok: Column) -> DataFrame:
    """One row of counts: rows, succeeded and failed; a null counts as failed."""
    good = F.coalesce(ok, F.lit(False))
    return results.agg(F.count("*").alias("total"), F.count_if(good).alias("succeeded"), F.count_if(~good).alias("failed"))
