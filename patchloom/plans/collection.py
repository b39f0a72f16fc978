"""Collection of change records from several sources into one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.functions import patches, text
from patchloom.operators import curation, relational

FIELDS = ["instance_id", "project", "base_commit", "security_patch", "test_patch", "test_files", "cwe_ids", "cve_id", "created_at", "language", "info_page"]


def _first_of(df: DataFrame, names: Sequence[str], rest: Column | None = None) -> Column:
    """The first of the columns that the table has, where not null; else ``rest``."""
    own = [F.col(c) for c in names if c in df.columns]
    return F.coalesce(*own, *([] if rest is None else [rest]), F.lit(None).cast("string"))


def with_fields(df: DataFrame, target: str = "python") -> DataFrame:
    """Adds the fields of a record, with their defaults where a source lacks them (null means lacking).

    project is owner/repo, created_at is commit_date, and info_page is html_url
    or the commit's page under repo_url.
    """
    text_of = lambda c: F.coalesce(F.col(c), F.lit("")) if c in df.columns else F.lit("")
    project = _first_of(df, ["project"], F.concat(text_of("owner"), F.lit("/"), text_of("repo")))
    page = _first_of(df, ["html_url"], F.concat(text_of("repo_url"), F.lit("/commit/"), F.col("commit_id")))
    made = _first_of(df, ["created_at", "commit_date"])
    out = df.withColumns({"project": project, "info_page": page, "created_at": made, "base_commit": F.col("commit_id"), "language": F.lit(target)})
    return out.withColumn("instance_id", text.instance_id(F.col("project"), F.col("commit_id")))


def listed_changes(records: DataFrame, statuses: DataFrame) -> DataFrame:
    """Records that list their changes as ``details (file_name, patch)``: recent ones whose page answers, with ``files`` and ``cwe_ids``.

    A file met twice has its last patch, at the place where it was first met.
    """
    own = curation.live(curation.recent(records), statuses)
    names = F.array_distinct(F.transform("details", lambda d: d["file_name"]))
    last = lambda name: F.element_at(F.filter("details", lambda d: d["file_name"] == name), -1)["patch"]
    return own.withColumn("files", F.transform(names, lambda n: F.struct(n.alias("path"), last(n).alias("hunk")))).withColumnRenamed("cwe_id", "cwe_ids")


def judged_changes(lines: DataFrame, target: str = "python", test: str = "python") -> DataFrame:
    """Records with one patch text, with ``files``, commit_id and ``reject``: why the text does not parse or is of another language, or null.

    ``lines`` has patch and commits, and ``_corrupt_record`` if it was read tolerantly.
    """
    good = lines.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record") if "_corrupt_record" in lines.columns else lines
    parsed = patches.with_files(curation.non_empty(good, "patch"))
    wanted = curation.target_language_only(F.col("files"), target, test)
    reason = F.coalesce(F.col("error"), F.when(~wanted, "other language or no tests"))
    return parsed.withColumn("reject", reason).drop("error").withColumn("commit_id", F.try_element_at("commits", F.lit(1))["commit_sha"])


def crawled_changes(lines: DataFrame, target: str = "python", test: str = "python") -> tuple[DataFrame, DataFrame]:
    """The accepted ``judged_changes`` and the rejected ones; a plan that needs both parses once by asking for those."""
    return curation.split_accepted(judged_changes(lines, target, test))


def crawl_plan(addresses: DataFrame, fetched: DataFrame) -> DataFrame:
    """Recent changes of a single commit with their ``patch``: their own, else that of ``fetched (owner, repo, sha, patch)``."""
    own = curation.single_commit(curation.recent(addresses, strict=True)).withColumn("sha", F.element_at("commits", 1)["commit_sha"])
    got = fetched.groupBy("owner", "repo", "sha").agg(F.max("patch").alias("__fetched"))
    joined = own.join(got, ["owner", "repo", "sha"], "left")
    patch = F.coalesce("patch", "__fetched") if "patch" in addresses.columns else F.col("__fetched")
    return joined.withColumn("patch", patch).select(*(c for c in addresses.columns if c != "patch"), "patch")


def collect(handlers: list[DataFrame], target: str = "python", test: str = "python", limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Records of all handlers, the first of each instance, and the rejected rows with their ``reject`` reason.

    A handler has commit_id, cve_id, cwe_ids, files, row_idx and what ``with_fields`` looks for.
    """
    every = relational.union_handlers(*(with_fields(h, target) for h in handlers))
    accepted, rejected = curation.split_accepted(curation.routed(every, target, test))
    first = relational.keep_first(accepted, "instance_id", ["handler_idx", "row_idx"])
    if limit is not None:
        first = first.orderBy("handler_idx", "row_idx").limit(limit)
    return first.select(*FIELDS), rejected


def projects(records: DataFrame) -> DataFrame:
    """The distinct projects, whose repositories have to be there before patches are checked."""
    return records.select("project").distinct()


def verified_records(records: DataFrame, checks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records of which both patches apply, by ``checks (instance_id, patch_applies)``, and the others; one without a check does not apply."""
    good = curation.applicable(records, checks, "instance_id")
    return good, records.join(good.select("instance_id"), "instance_id", "left_anti")
