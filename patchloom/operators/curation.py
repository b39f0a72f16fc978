"""Curation of change records: filters, routing of files and rendering of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.functions import patches, text
from patchloom.schemas import MOST_FILES, MOST_LINES, RECENT_YEAR, TEST_KEYWORD, TEST_SIDE_KEYWORDS


def recent(df: DataFrame, column: str = "cve_id", strict: bool = False) -> DataFrame:
    return df.filter(text.year_of_cve(F.col(column), strict) >= RECENT_YEAR)


def single_commit(df: DataFrame) -> DataFrame:
    return df.filter(F.size("commits") == 1)


def target_language_only(files: Column, target: str, test: str) -> Column:
    """Whether some known-code file is a test of the test language and all others are of the target's.

    ``files`` is an array of (path, hunk); files of unknown extensions count for nothing.
    """
    is_test = lambda f: F.contains(F.lower(f["path"]), F.lit(TEST_KEYWORD)) & text.of_language(f["path"], test)
    known = F.filter(files, lambda f: text.known_code(f["path"]))
    return F.exists(known, is_test) & F.forall(F.filter(known, lambda f: ~is_test(f)), lambda f: text.of_language(f["path"], target))


def test_side(path: Column) -> Column:
    """Whether a file goes with the tests: unknown code, or a keyword anywhere in its path."""
    return ~text.known_code(path) | text.has_keyword(path, TEST_SIDE_KEYWORDS)


def routed(df: DataFrame, target: str = "python", test: str = "python") -> DataFrame:
    """Adds security_patch, test_patch, test_files and ``reject``, the reason or null, from the array ``files``."""
    code = F.filter("files", lambda f: ~test_side(f["path"]))
    rest = F.filter("files", lambda f: test_side(f["path"]))
    is_test = lambda f: text.known_code(f["path"]) & F.contains(F.lower(f["path"]), F.lit(TEST_KEYWORD)) & text.of_language(f["path"], test)
    tests = F.transform(F.filter("files", is_test), lambda f: f["path"])
    out = df.withColumn("__code", code).withColumn("security_patch", patches.merged_patch(F.col("__code"))).withColumn("test_patch", patches.merged_patch(rest)).withColumn("test_files", tests)
    long = (patches.count_lines(F.col("security_patch")) > MOST_LINES) | (patches.count_files(F.col("security_patch")) > MOST_FILES)
    reason = F.when(long, "too long").when(~F.exists("__code", lambda f: text.of_language(f["path"], target)), "no target language").when(F.size("test_files") == 0, "no tests")
    return out.withColumn("reject", reason).drop("__code")


def split_accepted(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows and rejected ones."""
    return df.filter(F.col("reject").isNull()).drop("reject"), df.filter(F.col("reject").isNotNull())


def non_empty(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & (F.col(column) != ""))


def creates_no_file(df: DataFrame, column: str = "model_patch") -> DataFrame:
    return df.filter(~F.contains(F.col(column), F.lit("--- /dev/null")))


def mentions_no_test(df: DataFrame, column: str = "problem_statement") -> DataFrame:
    """Statements without 'test' at the start of a word; words that only contain it are no mention."""
    return df.filter(~F.regexp_like(F.col(column), F.lit(r"(?<![A-Za-z])test")))


def parser_accepted(b: Column, r: Column, p: Column, t: Column, k: Column, sec_test_done: Column, task_done: Column) -> Column:
    """'rejected' without failures or with a negative count, 'doubtful' if a run has fewer than it should, else 'accepted'."""
    counts = [b, r, p, t, k]
    none = (b + r + p + t + k) == 0
    negative = F.lit(False)
    for c in counts:
        negative = negative | (c < 0)
    doubtful = (sec_test_done & (t < b)) | (task_done & (k < r))
    return F.when(none | negative, "rejected").when(doubtful, "doubtful").otherwise("accepted")


def runs_allowed(runs: DataFrame, key: str = "instance_id") -> DataFrame:
    """Keys without a timeout in runs 0 to 2 or a startup error in runs 0 to 3."""
    bad = ((F.col("status") == "timeout") & (F.col("run_idx") < 3)) | ((F.col("status") == "startup_error") & (F.col("run_idx") != 4))
    return runs.groupBy(key).agg(F.bool_and(~bad).alias("ok")).filter("ok").select(key)


def required_fields(df: DataFrame) -> DataFrame:
    """Adds ``error`` for rows without an image name or a problem statement; no row goes."""
    gone = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return df.withColumn("error", F.when(gone("image_name"), "image_name missing").when(gone("problem_statement"), "problem_statement missing"))


def verified(results: DataFrame, text: str = "result") -> DataFrame:
    """Adds ``successful`` (both fields present) and ``verified`` (and not excessive) from a verifier's JSON."""
    got = F.from_json(text, "excessive_implementations boolean, explanation string")
    complete = got["excessive_implementations"].isNotNull() & got["explanation"].isNotNull()
    return results.withColumn("successful", F.coalesce(complete, F.lit(False))).withColumn("verified", F.col("successful") & ~F.coalesce(got["excessive_implementations"], F.lit(True)))


def applicable(df: DataFrame, checks: DataFrame, key: str = "instance_id") -> DataFrame:
    """Rows of which all patches apply, by a table of (key, patch_applies)."""
    good = checks.groupBy(key).agg(F.bool_and("patch_applies").alias("ok")).filter("ok").select(key)
    return df.join(good, key, "left_semi")


def live(df: DataFrame, statuses: DataFrame, url: str = "html_url") -> DataFrame:
    """Rows whose address is known to answer, by a table of (url, status)."""
    return df.join(statuses.filter("status = 200").select(F.col("url").alias(url)).distinct(), url, "left_semi")


def dataset_numbers(dataset: DataFrame) -> DataFrame:
    """Tasks, projects, distinct weaknesses and mean lines of a solution."""
    weaknesses = dataset.select(F.explode("cwe_ids").alias("id")).agg(F.count_distinct("id").alias("weaknesses"))
    rest = dataset.agg(F.count("*").alias("tasks"), F.count_distinct("project").alias("projects"), F.avg(patches.count_lines(F.col("golden_patch"))).alias("mean_lines"))
    return rest.join(F.broadcast(weaknesses))
