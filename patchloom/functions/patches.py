"""Unified diffs: counts as expressions on the text, strict parsing and line maps in Arrow batches."""

from __future__ import annotations

import ast
import difflib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchloom.functions.text import LINE_END, LINE_ENDS
from patchloom.schemas import HUNK_PATTERN, PATCH_FILES
from patchloom.session import prepare

#: What was just matched starts a line, at the text's start or after any line end.  Looking back only from there is
#: cheaper than looking for line starts.
STARTS_A_LINE = rf"(?<=(?:\A|[{LINE_ENDS}]){{0}})"
#: The line ends themselves, for dialects without escapes of Unicode characters.
PLAIN_LINE_END = LINE_END.encode().decode("unicode_escape")
BATCH_ROWS = 4096
#: So many diffs' lines are one batch.
PATCH_ROWS = 1024


def lines_of(text: str) -> list[str]:
    return text.splitlines()


def flat_map(df: DataFrame, inputs: list[str], function: Callable[..., Iterable[tuple]], schema: str) -> DataFrame:
    """Each row of ``df`` for every tuple that ``function`` yields for its ``inputs``, with the tuple's fields as further columns.

    Rows go through in Arrow batches where they are, without a shuffle; a row
    for which nothing is yielded goes.
    """
    prepare(df.sparkSession)
    own = [f.name for f in T.StructType.fromDDL(schema).fields]
    whole = T.StructType(df.schema.fields + T.StructType.fromDDL(schema).fields)
    places = [df.columns.index(c) for c in inputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in whole.fields[len(whole.fields) - len(own) :]]

        def batch_of(batch: pa.RecordBatch, rows: list[int], made: list[tuple]) -> pa.RecordBatch:
            kept = batch.take(pa.array(rows, pa.int64()))
            fresh = [pa.array(c, k) for c, k in zip(zip(*made, strict=True) if made else [()] * len(own), kinds, strict=True)]
            return pa.RecordBatch.from_arrays([*kept.columns, *fresh], [*batch.schema.names, *own])

        for batch in batches:
            rows: list[int] = []
            made: list[tuple] = []
            for i, values in enumerate(zip(*(batch.column(p).to_pylist() for p in places), strict=True)):
                for fields in function(*values):
                    rows.append(i)
                    made.append(fields)
                if len(rows) >= BATCH_ROWS:
                    yield batch_of(batch, rows, made)
                    rows, made = [], []
            if rows:
                yield batch_of(batch, rows, made)

    return df.mapInArrow(run, whole)


def touched_files(patch: Column) -> Column:
    """Distinct paths of the '+++ ' lines, cut at a tab, without 'b/'; /dev/null counts."""
    return F.array_distinct(F.regexp_extract_all(patch, F.lit(rf"\+\+\+ {STARTS_A_LINE.format(r'\+\+\+ ')}(?:b/)?([^\t{LINE_ENDS}]*)"), F.lit(1)))


def count_files(patch: Column) -> Column:
    return F.size(touched_files(patch))


def count_lines(patch: Column) -> Column:
    """Added and removed lines; what starts as a file header does is not counted."""
    return F.regexp_count(patch, F.lit(rf"(?:\+(?!\+\+ )|-(?!-- )){STARTS_A_LINE.format('[+-]')}"))


def merged_patch(files: Column) -> Column:
    """One diff of an array of (path, hunk), each with a header of three lines."""
    block = F.transform(files, lambda f: F.concat(F.lit("diff --git a/"), f["path"], F.lit(" b/"), f["path"], F.lit("\n--- a/"), f["path"], F.lit("\n+++ b/"), f["path"], F.lit("\n"), f["hunk"]))
    return F.concat(F.array_join(block, "\n"), F.lit("\n"))


GIT_HEADER = "diff --git "


def header_paths(line: str) -> tuple[str, str] | None:
    """The two paths of a block's first line, parted at the first ' b/'; None for another shape."""
    if not line.startswith(GIT_HEADER + "a/"):
        return None
    old, middle, new = line[len(GIT_HEADER) + 2 :].rstrip().partition(" b/")
    return (old, new) if middle else None


def file_patches(patch: str) -> Iterator[tuple[str, str | None, str | None]]:
    """``(path, hunk, error)`` of each file block; the first fault is the last item.

    Blocks start at 'diff --git ' lines.  Renames, copies, new and deleted
    files, missing headers and headers of another path are faults.
    """
    lines = lines_of(patch)
    heads = [i for i, line in enumerate(lines) if line.startswith(GIT_HEADER)]
    heads.append(len(lines))
    k = 0
    while (start := heads[k]) < len(lines):
        at = start + 1
        while at < len(lines) and not lines[at].startswith("--- "):
            at += 1
        while heads[k] < at:
            k += 1
        end = heads[k]
        paths = header_paths(lines[start])
        if paths is None:
            continue
        path, renamed = paths
        if path != renamed:
            yield path, None, f"path changed to {renamed}"
            return
        if at > start + 1 and any(x.startswith(("rename from ", "rename to ", "copy from ", "copy to ")) for x in lines[start + 1 : at]):
            yield path, None, "path changed by rename or copy"
            return
        if at + 1 >= end or not lines[at + 1].startswith("+++ "):
            yield path, None, "header missing"
            return
        if lines[at] != f"--- a/{path}" or lines[at + 1] != f"+++ b/{path}" or "\t" in path:
            old, new = (x[4:].split("\t")[0].strip() for x in lines[at : at + 2])
            if "/dev/null" in (old, new):
                yield path, None, "file created or deleted"
                return
            if (old, new) != (f"a/{path}", f"b/{path}"):
                yield path, None, "headers name another path"
                return
        yield path, "\n".join(lines[at + 2 : end]).rstrip("\n"), None


def patch_files(df: DataFrame, patch: str) -> DataFrame:
    """Rows of a strict parse, with pos, path, hunk and error; an error row ends a patch's rows."""

    def each(text: str | None) -> Iterator[tuple]:
        for i, (path, hunk, error) in enumerate(file_patches(text or "")):
            yield i, path, hunk, error

    return flat_map(df, [patch], each, "pos int, path string, hunk string, error string")


def with_files(df: DataFrame, patch: str = "patch") -> DataFrame:
    """Adds ``files``, the (path, hunk) of a strict parse, and ``error``, its fault or null.

    A path met twice has its last hunk, at the place where it was first met.  A
    null patch, and one without any block, has no files and no fault.
    """

    @F.arrow_udf(f"files {PATCH_FILES}, error string")
    def parse(texts: pa.Array) -> pa.Array:
        paths: list[str] = []
        hunks: list[str] = []
        ends: list[int | None] = []
        errors: list[str | None] = []
        for text in texts.to_pylist():
            found: dict[str, str] = {}
            fault = None
            for path, hunk, fault in file_patches(text or ""):
                if fault is None:
                    found[path] = hunk
            ends.append(None if fault else len(paths))
            if not fault:
                paths += found
                hunks += found.values()
            errors.append(fault)
        each = pa.StructArray.from_arrays([pa.array(paths, pa.string()), pa.array(hunks, pa.string())], ["path", "hunk"])
        files = pa.ListArray.from_arrays(pa.array([*ends, len(paths)], pa.int32()), each)
        return pa.StructArray.from_arrays([files, pa.array(errors, pa.string())], ["files", "error"])

    prepare(df.sparkSession)
    kept = [c for c in df.columns if c not in ("files", "error")]
    got = F.col(patch).cast("string")
    return df.select(*kept, parse(got).alias("__parsed")).select(*kept, "__parsed.files", "__parsed.error")


def patch_blocks(df: DataFrame, patch: str) -> DataFrame:
    """File blocks with pos, a_path, b_path and their text byte for byte; what precedes the first header, and blocks with a malformed one, go."""

    def each(text: str | None) -> Iterator[tuple]:
        parts = re.split(r"(?m)^(?=diff --git )", text or "")
        for i, part in enumerate(p for p in parts if p.startswith(GIT_HEADER)):
            paths = header_paths(part.split("\n", 1)[0])
            if paths:
                yield i, *paths, part

    return flat_map(df, [patch], each, "pos int, a_path string, b_path string, block string")


def lines_of_files(df: DataFrame, patch: str) -> DataFrame:
    """The diff's lines in place of the diff: pos, line and path, that of the last file header at or before a line, or null.

    All lines of a diff are in one row, so what each takes over from a header is
    settled in Arrow batches where the rows are, without a sort of the lines.  A
    malformed header's path is empty; a null diff has no lines.
    """
    prepare(df.sparkSession)
    own = [c for c in df.columns if c != patch]
    whole = T.StructType([df.schema[c] for c in own] + T.StructType.fromDDL("pos int, line string, path string").fields)

    def lines_of_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = pc.split_pattern_regex(batch.column(patch).cast(pa.string()), PLAIN_LINE_END)
        line, row = parts.flatten(), np.array(pc.list_parent_indices(parts))
        size = len(line)
        pos = np.arange(size) - np.searchsorted(row, row)
        last = np.append(row[1:] != row[:-1], [True])[:size]
        is_head = np.array(pc.starts_with(line, GIT_HEADER), bool)
        found = pc.extract_regex(line.filter(pa.array(is_head)), f"^{GIT_HEADER}a/(?P<path>.*?) b/")
        paths = pc.fill_null(pc.struct_field(found, "path"), "")
        head = np.maximum.accumulate(np.where(is_head, np.arange(size), -1))
        path = paths.take(pa.array(np.cumsum(is_head) - 1, mask=head < np.arange(size) - pos))
        kept = pa.array(~(last & np.array(pc.equal(line, ""), bool)))
        columns = [*(batch.column(c).take(pa.array(row)) for c in own), pa.array(pos.astype(np.int32)), line, path]
        return pa.RecordBatch.from_arrays(columns, whole.names).filter(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, PATCH_ROWS):
                yield lines_of_batch(batch.slice(start, PATCH_ROWS))

    return df.mapInArrow(run, whole)


def hunk_lines(hunks: str) -> Iterator[tuple[str, int | None, int | None]]:
    """'added', 'removed' and 'same' lines of a file's hunks, with their numbers before and after."""
    old = new = 0
    inside = False
    for line in lines_of(hunks or ""):
        m = re.match(HUNK_PATTERN, line)
        if m:
            old, new, inside = int(m[1]), int(m[3]), True
        elif inside and line[:1] == "+":
            yield "added", None, new
            new += 1
        elif inside and line[:1] == "-":
            yield "removed", old, None
            old += 1
        elif inside:
            yield "same", old, new
            old, new = old + 1, new + 1


def lines_of_hunks(df: DataFrame, hunks: str) -> DataFrame:
    """The rows of ``hunk_lines``: kind, old_ln and new_ln."""
    return flat_map(df, [hunks], hunk_lines, "kind string, old_ln int, new_ln int")


def spans_of_tests(source: str | None) -> tuple[list[tuple[str, int, int]], str | None]:
    """(name, start, end) of functions and methods whose name starts with 'test', decorators included, and the fault of what does not parse."""
    try:
        tree = ast.parse(source or "")
    except (SyntaxError, ValueError) as fault:
        return [], f"{type(fault).__name__}: {getattr(fault, 'msg', fault)}"
    found = [n for n in ast.walk(tree) if isinstance(n, ast.FunctionDef | ast.AsyncFunctionDef) and n.name.startswith("test")]
    return [(n.name, min([n.lineno, *(d.lineno for d in n.decorator_list)]), n.end_lineno) for n in found], None


def test_spans(df: DataFrame, source: str) -> DataFrame:
    """Rows with name, start and end of the tests of a Python source, and one with only ``fault`` for what does not parse."""

    def each(text: str | None) -> Iterator[tuple]:
        spans, fault = spans_of_tests(text)
        if fault:
            yield None, None, None, fault
        for span in spans:
            yield *span, None

    return flat_map(df, [source], each, "name string, start int, end int, fault string")


test_spans.__test__ = False


def kept_lines(changed: Iterable[tuple[str, int | None, int | None]], before: str | None, after: str | None) -> Iterator[tuple[int, int]]:
    """(new, old) of unchanged lines: the n-th that is not added is the n-th that is not removed."""
    changed = list(changed)
    added = {new for kind, _, new in changed if kind == "added"}
    removed = {old for kind, old, _ in changed if kind == "removed"}
    old = (i for i in range(1, len(lines_of(before or "")) + 1) if i not in removed)
    new = (i for i in range(1, len(lines_of(after or "")) + 1) if i not in added)
    return zip(new, old, strict=False)


def line_map(df: DataFrame, hunks: str, before: str, after: str) -> DataFrame:
    """Unchanged lines by new_ln and old_ln: the n-th that is not added is the n-th that is not removed."""
    return flat_map(df, [hunks, before, after], lambda text, one, two: kept_lines(hunk_lines(text), one, two), "new_ln int, old_ln int")


def touched_tests(hunks: str | None, before: str | None, after: str | None) -> tuple[set[tuple[int, int]], str | None]:
    """The spans before of the tests that hunks touch, and the fault of what does not parse.

    A test is touched if a removed line is in it before, or an added line is in
    it after; the latter is found before by the line its start had.
    """
    (own, fault), (later, other) = spans_of_tests(before), spans_of_tests(after)
    if fault or other:
        return set(), min(f for f in (fault, other) if f)
    changed = list(hunk_lines(hunks))
    removed = sorted({old for kind, old, _ in changed if kind == "removed"})
    added = sorted({new for kind, _, new in changed if kind == "added"})
    holds = lambda lines, start, end: bisect_left(lines, start) < bisect_right(lines, end)
    starts = {start for _, start, end in later if holds(added, start, end)}
    known = {old for new, old in kept_lines(changed, before, after) if new in starts} if starts else set()
    return {(start, end) for _, start, end in own if start in known or holds(removed, start, end)}, None


def _series(function: Callable[..., str]) -> Callable[..., pd.Series]:
    """A Pandas UDF body that applies ``function`` to the values of each row."""

    def run(*columns: pd.Series) -> pd.Series:
        return pd.Series([function(*values) for values in zip(*columns, strict=True)], dtype=object)

    return run


def unified_diff(before: Column | str, after: Column | str) -> Column:
    """The hunks between two texts, with their line ends and without file headers."""

    def diff(one: str | None, two: str | None) -> str:
        if (one or "") == (two or ""):
            return ""
        got = list(difflib.unified_diff((one or "").splitlines(keepends=True), (two or "").splitlines(keepends=True)))
        first = next((i for i, x in enumerate(got) if x.startswith("@@")), len(got))
        return "".join(got[first:])

    prepare()

    @F.pandas_udf(T.StringType())
    def of(one: pd.Series, two: pd.Series) -> pd.Series:
        return _series(diff)(one, two)

    return of(before, after)


def without_lines(source: str | None, spans: Iterable[tuple[int, int]]) -> str:
    """The text without the lines of 1-based inclusive spans."""
    gone = {i for start, end in spans for i in range(start, end + 1)}
    return "".join(x for i, x in enumerate((source or "").splitlines(keepends=True), 1) if i not in gone)


def without_spans(text: Column | str, spans: Column | str) -> Column:
    """The text without the lines of 1-based inclusive spans."""

    def cut(source: str | None, own) -> str:
        return without_lines(source, [(s["start"], s["end"]) for s in (own if own is not None else [])])

    prepare()

    @F.pandas_udf(T.StringType())
    def of(one: pd.Series, two: pd.Series) -> pd.Series:
        return _series(cut)(one, two)

    return of(text, spans)


def without_touched_tests(hunks: Column | str, before: Column | str, after: Column | str) -> Column:
    """The struct (masked, fault): ``before`` without the tests that the hunks touch, or why either source does not parse."""
    prepare()

    @F.pandas_udf("masked string, fault string")
    def of(changes: pd.Series, one: pd.Series, two: pd.Series) -> pd.DataFrame:
        masked, faults = [], []
        for hunk, old, new in zip(changes, one, two, strict=True):
            spans, fault = touched_tests(hunk, old, new)
            masked.append(None if fault else without_lines(old, spans) if spans else old or "")
            faults.append(fault)
        return pd.DataFrame({"masked": masked, "fault": faults}, dtype=object)

    return of(hunks, before, after)


def _added_to(patch: str, name: str) -> str:
    """The lines that a diff adds to the file of that base name, joined by line feeds."""
    here = inside = False
    out = []
    for line in lines_of(patch):
        if line.startswith(GIT_HEADER):
            here = inside = False
        elif line.startswith("+++ "):
            here = line[4:].strip(" ").rsplit("/", 1)[-1] == name
        elif line.startswith("@@"):
            inside = True
        elif here and inside and line.startswith("+") and not line.startswith("+++"):
            out.append(line[1:])
    return "\n".join(out)


def added_text(df: DataFrame, patch: str, name: str, key: str = "instance_id", out: str = "text") -> DataFrame:
    """Per row the lines that its diff adds to the file of that base name, in any folder, joined by line feeds.

    File and hunk headers set a state that the lines below inherit, so each
    patch is read once, in Arrow batches; a null patch adds nothing.
    """

    @F.pandas_udf(T.StringType())
    def added(texts: pd.Series) -> pd.Series:
        return pd.Series(["" if t is None or name not in t else _added_to(t, name) for t in texts], dtype=object)

    prepare(df.sparkSession)
    return df.withColumn(out, added(F.col(patch)))


def filtered_patch(df: DataFrame, patch: str, targets: list[str] | str, exclude: bool = False, out: str = "filtered_patch") -> DataFrame:
    """Adds the diff with only the blocks of the target files, or without them; rows and other columns stay.

    ``targets`` is a list of paths, or the name of a column that holds one for
    each row.  A block whose header is malformed goes, and so does what precedes
    the first header.
    """
    blocks = F.split(F.coalesce(F.col(patch), F.lit("")), rf"(?<=[{LINE_ENDS}])(?={GIT_HEADER})", -1)
    wanted = F.coalesce(F.col(targets), F.array().cast("array<string>")) if isinstance(targets, str) else F.lit(targets).cast("array<string>")
    start = GIT_HEADER + "a/"

    def paths(block: Column) -> Column:
        """The array (a path, b path) of a block's first line, parted at the first ' b/'."""
        line = F.substring(F.substring_index(block, "\n", 1), len(start) + 1, 1 << 30)
        old = F.substring_index(line, " b/", 1)
        return F.array(old, F.right(line, F.length(line) - F.length(old) - 3))

    def kept(block: Column) -> Column:
        formed = F.startswith(block, F.lit(start)) & F.contains(F.substring_index(block, "\n", 1), F.lit(" b/"))
        inside = F.arrays_overlap(wanted, paths(block))
        return formed & (~inside if exclude else inside)

    return df.withColumn(out, F.array_join(F.filter(blocks, kept), ""))
