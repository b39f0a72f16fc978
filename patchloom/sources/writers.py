"""Writers of record tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def reports(df: DataFrame, path: str, force: bool = False) -> None:
    """Partitions by run, strategy and model; with ``force``, those met are replaced, else rows are added."""
    out = df.write.partitionBy("run_id", "strategy", "model")
    if force:
        out.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    else:
        out.mode("append").parquet(path)


def still_to_do(work: DataFrame, done: DataFrame, key: str = "instance_id", force: bool = False) -> DataFrame:
    """Work whose key has no result yet, or all of it with ``force``."""
    return work if force else work.join(done.select(key).distinct(), key, "left_anti")


def text_lines(df: DataFrame, path: str, column: str = "text") -> None:
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def yaml_rows(df: DataFrame, path: str) -> None:
    """A YAML sequence: each row is an item in flow style, that is its JSON, which YAML reads as it is."""
    df.select(F.concat(F.lit("- "), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})).alias("value")).write.mode("overwrite").text(path)


def rendered_tasks(df: DataFrame) -> DataFrame:
    """(instance_id, file, text): the statement, the meta page, and a fenced diff of each patch column the table has."""
    fenced = {"golden_patch": "golden.md", "mask_patch": "mask.md", "security_patch": "security_fix.md"}
    files = [F.struct(F.lit("problem_statement.md").alias("file"), F.col("problem_statement").alias("text"))]
    files += [F.struct(F.lit(name).alias("file"), F.concat(F.lit("```diff\n\n"), F.col(c), F.lit("\n```")).alias("text")) for c, name in fenced.items() if c in df.columns]
    if {"project", "info_page", "cve_id", "cwe_ids"} <= set(df.columns):
        lines = [("Project: ", F.col("project")), ("Vulnerability fix commit: [Github Page](", F.concat("info_page", F.lit(")"))), ("Security issue identifier: ", F.col("cve_id")), ("Vulnerability type: ", F.array_join("cwe_ids", ", "))]
        body = F.concat(F.lit("\n# Meta Information\n\n"), *(F.concat(F.lit(label), value, F.lit("\n\n")) for label, value in lines))
        files.append(F.struct(F.lit("meta_info.md").alias("file"), body.alias("text")))
    return df.select("instance_id", F.inline(F.array(*files))).filter(F.col("text").isNotNull())


def text_files(tasks: DataFrame, path: str) -> None:
    """The rows of ``rendered_tasks`` in a folder for each instance and file."""
    tasks.select("instance_id", "file", F.col("text").alias("value")).write.mode("overwrite").partitionBy("instance_id", "file").option("lineSep", "\n").text(path)
