"""Masks for the tests that a patch touches: spans, line maps and cuts of one file in one pass, then a diff per file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchloom.functions import patches, text
from patchloom.schemas import TEST_KEYWORD


def masked_tests(files: DataFrame) -> DataFrame:
    """Adds ``masked``, ``before`` without the touched test functions, ``mask``, the diff to it, and ``fault``.

    ``files`` has hunks, before and after.  A test is touched if a removed line
    is in it before, or an added line is in it after; the latter is found before
    by the line its start had.  Where either source does not parse, ``fault``
    says why, and ``masked`` and ``mask`` are null.  All of this is the file's
    own, so rows stay where they are, and no join or shuffle is made.
    """
    got = files.withColumn("__got", patches.without_touched_tests("hunks", "before", "after"))
    cut = got.select(*files.columns, "__got.fault", "__got.masked")
    return cut.withColumn("mask", F.when(F.col("fault").isNull(), patches.unified_diff("before", "masked")))


def restored(records: DataFrame, sources: DataFrame, test: str = "python") -> DataFrame:
    """All ``records`` with ``fault`` and, where it is null, the ``test_patch`` of ``expanded_masks``; one pass over both tables.

    The files of a patch are parted and met with their sources, once each; a
    file that is no test goes along without a mask.
    """
    parsed = patches.with_files(records.select("instance_id", "test_patch"), "test_patch")
    none = F.coalesce(F.size("files"), F.lit(0)) == 0
    each = parsed.select("instance_id", F.coalesce("error", F.when(none, "no files")).alias("error"), F.posexplode_outer("files").alias("pos", "f")).select("instance_id", "error", "pos", F.col("f.path").alias("path"), F.col("f.hunk").alias("hunks"))
    files = each.join(sources.select("instance_id", "path", "before", "after", F.lit(True).alias("here")), ["instance_id", "path"], "left")
    is_test = F.contains(F.lower("path"), F.lit(TEST_KEYWORD)) & text.of_language(F.col("path"), test)
    of_test = lambda c: F.when(is_test, F.col(c))
    cut = files.withColumn("__got", patches.without_touched_tests(of_test("hunks"), of_test("before"), of_test("after")))
    fault = F.when(F.col("here").isNull(), F.when(F.col("path").isNotNull(), "no source")).otherwise(F.col("__got.fault"))
    masked = F.when(is_test, F.col("__got.masked")).otherwise(F.col("before"))
    every = cut.select("instance_id", "error", "pos", "path", fault.alias("fault"), masked.alias("masked"), "after")
    hunk = patches.unified_diff(F.col("masked"), F.col("after"))
    ready = every.select("instance_id", "error", "pos", "path", "fault", F.when(F.col("fault").isNull(), hunk).alias("hunk"))
    rows = F.array_sort(F.collect_list(F.struct("pos", "path", "hunk")))
    whole = ready.groupBy("instance_id").agg(F.coalesce(F.max("error"), F.max("fault")).alias("fault"), F.filter(rows, lambda r: r["hunk"] != "").alias("r"))
    merged = patches.merged_patch(F.transform("r", lambda r: F.struct(r["path"].alias("path"), F.regexp_replace(r["hunk"], "\n$", "").alias("hunk"))))
    new = whole.select("instance_id", "fault", merged.alias("__patch"))
    out = records.join(new, "instance_id")
    return out.select(*(F.when(F.col("fault").isNull(), F.col("__patch")).otherwise(F.col(c)).alias(c) if c == "test_patch" else c for c in records.columns), "fault")


def expanded_masks(records: DataFrame, sources: DataFrame, test: str = "python") -> tuple[DataFrame, DataFrame]:
    """Records whose ``test_patch`` restores the masked tests whole, and those rejected, with ``fault``.

    ``records`` has instance_id and test_patch; ``sources`` (instance_id, path,
    before, after) has the files that test patches touch.  The new patch of a
    test file leads from its masked text to ``after``, that of another file from
    ``before``.  A record is rejected if its patch is no strict diff or is
    without a file's source, or if a test file does not parse.
    """
    out = restored(records, sources, test)
    return out.filter("fault IS NULL").drop("fault"), out.filter("fault IS NOT NULL")
