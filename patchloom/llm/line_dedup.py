"""Line dedup by overlapping windows of three lines.

Every window of ``WINDOW`` consecutive lines is hashed (128 bits).  Windows met
more than once in the corpus are joined back to their places; a place is later
if an earlier place of the same row, or a row with a smaller ``doc_id``, has
the same window.  The lines that later windows cover are merged and removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.llm.session import cut_lineage, prepare, schema_of, with_names

WINDOW = 3
#: A window is hot if it has over a FEW_HOT-th of all repeated places, or over HOT_PLACES; at most MOST_HOT windows can be.
FEW_HOT, HOT_PLACES, MOST_HOT = 2000, 200_000, 50_000
#: A hot window's places are dealt by this many salts at least, and by one for each HOT_PLACES of them.
SALTS = 32
ROWS_AT_ONCE = 512
LEAST_ID = -(2**63)


def _windows(docs: DataFrame, size: int) -> DataFrame:
    """One row per window with a line that is not blank: row key, position and hash."""
    lines = F.split("text", "\n", -1)
    n = F.greatest(F.size(lines) - (size - 1), F.lit(0))
    zipped = F.arrays_zip(*(F.slice(lines, i + 1, n).alias(f"l{i}") for i in range(size)))
    each = docs.select("d", "t", F.posexplode(zipped).alias("pos", "w"))
    fields = [F.col(f"w.l{i}") for i in range(size)]
    # Lines of spaces only are blank; those of other white space are not.
    blank: Column = F.trim(F.concat(*fields)) == ""
    return each.filter(~blank).select("d", "t", "pos", F.xxhash64(*fields).alias("h1"), F.xxhash64(F.lit(1), *reversed(fields)).alias("h2"))


def _met(docs: DataFrame, size: int) -> DataFrame:
    """``(d, t, pos, h1, h2, first)``: the places of the windows met more than once, and the least row key that has each.

    Hot windows are named by a broadcast of ``MOST_HOT`` rows at most, and their
    places are dealt by salts, more for windows of more places, so what a task
    gets of one window does not grow with the corpus, until the windows over
    ``HOT_PLACES`` are more than ``MOST_HOT``.
    """
    windows = _windows(docs, size)
    common = cut_lineage(windows.groupBy("h1", "h2").agg(F.min("d").alias("first"), F.count("*").alias("n")).filter("n > 1"))
    total = common.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") > max(min(total / FEW_HOT, HOT_PLACES), total / MOST_HOT)
    own_salts = F.greatest(F.lit(SALTS), F.ceil(F.col("n") / HOT_PLACES).cast("int"))
    hot = common.filter(is_hot).select("h1", "h2", own_salts.alias("salts"))
    salt = F.coalesce(F.pmod(F.xxhash64("d", "pos"), F.col("salts")).cast("int"), F.lit(0))
    placed = windows.join(F.broadcast(hot), ["h1", "h2"], "left").withColumn("salt", salt).drop("salts")
    salts = F.when(is_hot, F.sequence(F.lit(0), own_salts - 1)).otherwise(F.array(F.lit(0)))
    return cut_lineage(placed.join(common.select("h1", "h2", "first", F.explode(salts).alias("salt")), ["h1", "h2", "salt"]).drop("salt"))


def _later(docs: DataFrame, size: int) -> DataFrame:
    """``(d, t, later)``: for each row the places whose window is met earlier, in the row or in one of a smaller key."""
    met = _met(docs, size)
    earliest = met.filter("d = first").groupBy("d", "t", "h1", "h2").agg(F.min("pos").alias("earliest"), F.count("*").alias("n")).filter("n > 1").drop("n")
    inner = met.filter("d = first").join(earliest, ["d", "t", "h1", "h2"]).filter("pos > earliest").select("d", "t", "pos")
    later = met.filter("d > first").select("d", "t", "pos").union(inner)
    return later.groupBy("d", "t").agg(F.collect_set("pos").alias("later"))


def _covered(later: list[int], size: int) -> set[int]:
    return {p + i for p in later for i in range(size)}


def _remove(size: int, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(lo, ROWS_AT_ONCE)
                texts, later = some.column(text_at).to_pylist(), some.column(some.num_columns - 1).to_pylist()
                total, gone = [], []
                for i, (text, places) in enumerate(zip(texts, later, strict=True)):
                    total.append(0 if text is None else text.count("\n") + 1)
                    covered = _covered(places, size) if places else ()
                    gone.append(len(covered))
                    if covered:
                        texts[i] = "\n".join(line for k, line in enumerate(text.split("\n")) if k not in covered)
                columns = [pa.array(texts, pa.string()) if i == text_at else some.column(i) for i in range(some.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(total, pa.int64()), pa.array(gone, pa.int64())], [*some.schema.names[:-1], "lines", "removed"])

    return run


def _with_counts(docs: DataFrame, size: int) -> DataFrame:
    """``docs`` without the lines, and ``lines`` and ``removed`` as its last two columns."""
    prepare(docs.sparkSession)

    def cut(plain: DataFrame) -> DataFrame:
        text = F.col("text").cast("string")
        keyed = plain.withColumn("d", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LEAST_ID))).withColumn("t", F.xxhash64(text))
        later = _later(keyed.select("d", "t", text.alias("text")), size)
        joined = keyed.join(later, ["d", "t"], "left").select(*plain.columns, "later")
        return joined.mapInArrow(_remove(size, plain.columns.index("text")), f"{schema_of(plain)}, lines bigint, removed bigint")

    return with_names(docs, ["doc_id", "text"], cut)


def remove_repeated_windows(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """All rows and columns of ``docs``, whatever their names, with later windows' lines gone from ``text``.

    A text has one line more than line feeds; a null text has none and stays
    null; a text with fewer lines than a window, and windows of lines of spaces
    only, are left alone.  A null ``doc_id`` counts as smaller than all others.
    Rows that share a ``doc_id`` are no later than each other, and rows that
    also share the text get the same result.  An empty table stays empty.
    """
    out = _with_counts(docs, size)
    return out.toDF(*(f"c{i}" for i in range(len(out.columns)))).select(*(f"c{i}" for i in range(len(docs.columns)))).toDF(*docs.columns)


def line_report(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_removed`` and the remaining ``text``, for each row; edge cases as in ``remove_repeated_windows``."""
    return _with_counts(docs.select("doc_id", "text"), size).select("doc_id", F.col("lines").alias("n_lines"), F.col("removed").alias("n_removed"), "text")


ORACLE_SQL = """
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)
), windows AS (
  SELECT doc_id, pos, line AS l0, lead(line, 1) OVER w AS l1, lead(line, 2) OVER w AS l2 FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), later AS (
  SELECT doc_id, pos FROM (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY l0, l1, l2 ORDER BY doc_id, pos) AS nth
    FROM windows WHERE l2 IS NOT NULL AND trim(concat(l0, l1, l2)) <> ''
  ) WHERE nth > 1
), covered AS (
  SELECT DISTINCT doc_id, pos + i AS pos FROM later, (SELECT unnest([0, 1, 2]) AS i)
)
SELECT l.doc_id, count(*) AS n_lines, count(c.pos) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY l.pos) FILTER (WHERE c.pos IS NULL), '') AS text
FROM lines l LEFT JOIN covered c ON l.doc_id = c.doc_id AND l.pos = c.pos GROUP BY l.doc_id
"""
