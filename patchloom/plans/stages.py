"""Task generation around agent runs: what is asked before each run, and what its outputs change after it.

The runs themselves are outside; their outputs are tables: ``predictions``
(instance_id, model_patch), ``statuses`` (status, instance_ids) and checks of
whether patches apply (instance_id, patch_applies).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.functions import patches, render, text
from patchloom.operators import curation, relational
from patchloom.schemas import DEV_TOOL, DEV_TOOL_VERSIONS, UNIGNORED

# Exit statuses of runs that handed something in.
SUBMITTED = ["skipped (submitted)", "submitted"]


def agent_tasks(df: DataFrame, statement: Column, repository: Column, kind: str = "local", image: Column | None = None, commit: Column | None = None) -> DataFrame:
    """Nested rows for an agent batch: the deployment, the repository and the statement with its id.

    ``kind`` is 'local', a path, or 'preexisting', a name in the image.
    """
    if kind not in ("local", "preexisting"):
        raise ValueError(f"unknown kind {kind}")
    place = repository.alias("path" if kind == "local" else "repo_name")
    repo = F.struct(F.lit(kind).alias("type"), F.coalesce(commit if commit is not None else F.lit(None), F.lit("HEAD")).alias("base_commit"), place)
    own = F.coalesce(image if image is not None else F.lit(None), F.lit("python:3.11"))
    deployment = F.struct(F.lit("docker").alias("type"), own.alias("image"), F.lit("/root").alias("python_standalone_dir"))
    asked = F.struct(F.lit("text").alias("type"), statement.alias("text"), F.col("instance_id").alias("id"))
    return df.select(F.struct(deployment.alias("deployment"), repo.alias("repo")).alias("env"), asked.alias("problem_statement"))


def mask_requests(records: DataFrame, rollbacks: DataFrame, template: str, ratio: float = 2, cap: int | None = None, ids: Sequence[str] | None = None, order: str = "_pos") -> DataFrame:
    """Records to mask, with ``ratio``, ``statement`` and the ``rollback`` commit to start from.

    The ratio shrinks along the records' order so that no mask passes ``cap``
    lines.  Records without a row in ``rollbacks (instance_id, rollback)`` are
    left out, and do not shrink it.
    """
    own = relational.only_ids(records, "instance_id", ids).join(rollbacks.select("instance_id", "rollback"), "instance_id")
    if cap is None:
        out = own.withColumn("ratio", F.lit(round(float(ratio), 1)))
    else:
        sized = own.withColumn("__lines", patches.count_lines(F.col("security_patch")))
        out = relational.running_least_ratio(sized, "__lines", order, ratio, cap).drop("__lines")
    return out.withColumn("statement", render.filled(F.lit(template), {"ratio": F.col("ratio").cast("string"), "diff_patch": F.col("security_patch")}))


def statement_requests(tasks: DataFrame, template: str, ids: Sequence[str] | None = None) -> DataFrame:
    """Tasks to describe, with the ``statement`` that asks for it."""
    return relational.only_ids(tasks, "instance_id", ids).withColumn("statement", render.filled(F.lit(template), {"mask_patch": F.col("mask_patch")}))


def verifier_requests(tasks: DataFrame, code: DataFrame, template: str, ids: Sequence[str] | None = None) -> DataFrame:
    """Tasks to verify, with the ``statement``; ``code (instance_id, code_patch)`` has the diffs from masked to whole code."""
    own = relational.only_ids(tasks, "instance_id", ids).join(code.select("instance_id", "code_patch"), "instance_id")
    return own.withColumn("statement", render.filled(F.lit(template), {"task_desc": F.col("problem_statement"), "code_patch": F.col("code_patch")})).drop("code_patch")


def handed_in(predictions: DataFrame, statuses: DataFrame, checks: DataFrame) -> DataFrame:
    """Predictions that are not empty, were handed in, and apply."""
    own = relational.submitted(curation.non_empty(predictions, "model_patch"), statuses, "instance_id", SUBMITTED)
    return curation.applicable(own, checks, "instance_id")


def with_masks(tasks: DataFrame, processed: DataFrame, predictions: DataFrame, statuses: DataFrame, checks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tasks with the new ``mask_patch``, new tasks from ``processed`` among them, and the ids that succeeded."""
    good = curation.creates_no_file(handed_in(predictions, statuses, checks)).select("instance_id", F.col("model_patch").alias("mask_patch"))
    new = processed.drop("mask_patch").join(good, "instance_id")
    return relational.upsert(tasks, new, "instance_id", ["mask_patch"]), good.select("instance_id")


def with_statements(tasks: DataFrame, statements: DataFrame, predictions: DataFrame, statuses: DataFrame, checks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tasks with the new ``problem_statement`` that mentions no test, and the ids that succeeded."""
    ready = statements.join(handed_in(predictions, statuses, checks).select("instance_id"), "instance_id", "left_semi")
    good = curation.mentions_no_test(ready.select("instance_id", "problem_statement"))
    return relational.update_matched(tasks, good, "instance_id", "problem_statement"), good.select("instance_id")


def with_verdicts(tasks: DataFrame, results: DataFrame, predictions: DataFrame, statuses: DataFrame, checks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tasks with ``task_patch`` where a verifier found nothing excessive, and (instance_id, verified) of those it succeeded for.

    ``results`` has instance_id, the verifier's JSON ``result``, task_patch and
    ``reapplied``, whether task and test patch still apply.
    """
    own = results.filter("reapplied").join(handed_in(predictions, statuses, checks).select("instance_id"), "instance_id", "left_semi")
    judged = curation.verified(own).filter("successful")
    return relational.update_matched(tasks, judged.filter("verified").select("instance_id", "task_patch"), "instance_id", "task_patch"), judged.select("instance_id", "verified")


def without_results(results: DataFrame, ids: DataFrame) -> DataFrame:
    """The results whose id is not to be done anew."""
    return relational.pending(results, ids, "instance_id")


def retried(asked: DataFrame, successful: DataFrame, verified: DataFrame) -> DataFrame:
    """Ids for the next round: what failed in any stage, and what succeeded without being verified."""
    done = verified.filter("verified").select("instance_id")
    return relational.pending(asked.select("instance_id").union(successful.select("instance_id")).distinct(), done, "instance_id")


def finished_tasks(tasks: DataFrame) -> DataFrame:
    """The tasks that have a ``task_patch``."""
    return tasks.filter(F.col("task_patch").isNotNull())


def task_stats(tasks: DataFrame) -> DataFrame:
    """(instance_id, num_files_edited, num_lines_edited) of the masks."""
    mask = F.col("mask_patch")
    return tasks.select("instance_id", patches.count_files(mask).alias("num_files_edited"), patches.count_lines(mask).alias("num_lines_edited"))


def merged_stats(stats: DataFrame, tests: DataFrame) -> DataFrame:
    """The statistics with num_sec_tests and num_func_tests of the instances that ``tests`` has; the others' stay as they are."""
    own = ["num_sec_tests", "num_func_tests"]
    new = tests.select("instance_id", *(F.col(c).alias(f"__{c}") for c in own), F.lit(True).alias("__here"))
    joined = stats.join(new, "instance_id", "left")
    old = lambda c: F.col(c) if c in stats.columns else F.lit(None).cast("int")
    return joined.select(*(c for c in stats.columns if c not in own), *(F.when(F.col("__here"), F.col(f"__{c}")).otherwise(old(c)).alias(c) for c in own))


def dev_tools(results: DataFrame, available: dict[str, list[str]] = DEV_TOOL_VERSIONS) -> DataFrame:
    """(instance_id, name, version, additional_info) from the JSON ``result``: known tools at the nearest version there is."""
    got = results.select("instance_id", F.from_json("result", DEV_TOOL).alias("t")).select("instance_id", "t.*").filter("name IS NOT NULL AND version IS NOT NULL")
    version = F.lit(None).cast("string")
    for name, versions in available.items():
        version = F.when(F.col("name") == name, relational.nearest_version(F.col("version"), versions)).otherwise(version)
    return got.filter(F.col("name").isin(list(available))).withColumn("version", version)


def environment_requests(tasks: DataFrame, tools: DataFrame, excluded: Sequence[str] = (), ids: Sequence[str] | None = None) -> DataFrame:
    """Tasks whose project is allowed and whose tool is known, with the tool's ``version``."""
    own = relational.only_ids(tasks, "instance_id", ids).filter(~F.col("project").isin(list(excluded)) if excluded else F.lit(True))
    return own.join(tools.select("instance_id", "version"), "instance_id")


def environment_specs(predictions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(instance_id, dockerfile, dockerignore) from the files that a prediction's diff creates at the root, and (instance_id, fault).

    An ignore file gets the lines that keep the repository itself; without one
    it is empty.  Without a Dockerfile there is no specification.
    """
    own = patches.filtered_patch(predictions.select("instance_id", "model_patch"), "model_patch", ["Dockerfile", ".dockerignore"], out="__patch")
    for name, out in (("Dockerfile", "__docker"), (".dockerignore", "__ignore")):
        own = patches.added_text(own, "__patch", name, out=out)
    ignore = F.when(F.col("__ignore") == "", "").otherwise(F.concat("__ignore", F.lit("\n\n" + "\n".join(UNIGNORED))))
    there = F.col("__docker") != ""
    good = own.filter(there).select("instance_id", F.concat("__docker", F.lit("\n")).alias("dockerfile"), ignore.alias("dockerignore"))
    return good, own.filter(~there).select("instance_id", F.lit("no Dockerfile").alias("fault"))


def golden_patches(sources: DataFrame) -> DataFrame:
    """(instance_id, golden_patch): the diff from masked to base code, of ``sources (instance_id, path, masked, base)``, in order of path."""
    each = sources.select("instance_id", "path", F.regexp_replace(patches.unified_diff("masked", "base"), "\n$", "").alias("hunk")).filter("hunk <> ''")
    lists = each.groupBy("instance_id").agg(F.array_sort(F.collect_list(F.struct("path", "hunk"))).alias("files"))
    return lists.select("instance_id", patches.merged_patch(F.col("files")).alias("golden_patch"))


def dataset_records(tasks: DataFrame, golden: DataFrame) -> DataFrame:
    """Tasks with their ``golden_patch``, without mask_patch and test_files."""
    return tasks.drop("golden_patch").join(golden.select("instance_id", "golden_patch"), "instance_id").drop("mask_patch", "test_files")


def prepared(dataset: DataFrame, strategy: str, names: DataFrame | None = None, selection_text: str = "", feedback_text: str = "") -> DataFrame:
    """The dataset with each statement guarded by the strategy's text."""
    return render.guarded(dataset, strategy, names, selection_text, feedback_text).select(*dataset.columns)


def strategy_path(path: str, strategy: str) -> str:
    """Where a prepared dataset goes: the strategy after the file's stem."""
    folder, slash, name = path.rpartition("/")
    stem, dot, ending = name.rpartition(".")
    return f"{folder}{slash}{stem}_{strategy}{dot}{ending}" if dot and stem else f"{path}_{strategy}"


def evaluation_tasks(dataset: DataFrame, strategy: str, workspace: str, **guard) -> DataFrame:
    """Agent tasks of a dataset under a strategy, in the repository that the instance's image holds."""
    own = prepared(dataset, strategy, **guard)
    return agent_tasks(own, F.col("problem_statement"), F.lit(workspace), "preexisting", F.col("image_name"))


def image_names(dataset: DataFrame, user: str, family: str) -> DataFrame:
    return dataset.withColumn("image_name", text.hub_image_name(F.col("instance_id"), user, family))
