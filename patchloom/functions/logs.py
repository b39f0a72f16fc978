"""Test-log classification by regular expressions, on the rows as they are."""

from __future__ import annotations

import re
from functools import cache, lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchloom.functions.patterns import PatternSet
from patchloom.schemas import FAILURE_STATUSES, ITEM_STATUSES, STARTUP_ERROR_PATTERNS, SYMBOL_ERROR_PATTERNS
from patchloom.session import prepare


def java_pattern(pattern: str) -> str:
    """A Python multi-line pattern in Java's dialect, with Python's line ends, classes and end anchor."""
    return "(?mdU)" + pattern.replace(r"\Z", r"\z").replace(r"\s", r"[\s\x1c-\x1f]").replace("(?P<", "(?<")


@cache
def _fault_patterns() -> PatternSet:
    return PatternSet([*STARTUP_ERROR_PATTERNS, *SYMBOL_ERROR_PATTERNS])


@F.pandas_udf(T.StructType([T.StructField("startup", T.BooleanType()), T.StructField("symbols", T.IntegerType())]))
def _log_faults(logs: pd.Series) -> pd.DataFrame:
    known, first = _fault_patterns(), len(STARTUP_ERROR_PATTERNS)
    startup, symbols = [], []
    for log in logs:
        possible = known.possible(log) if log is not None else []
        startup.append(None if log is None else known.any(log, [i for i in possible if i < first]))
        symbols.append(None if log is None else known.count(log, [i for i in possible if i >= first]))
    return pd.DataFrame({"startup": pd.array(startup, "boolean"), "symbols": pd.array(symbols, "Int32")})


def log_faults(logs: Column) -> Column:
    """The struct (startup, symbols): whether a run did not start, and its symbol errors, from one pass over the log.

    A null log has nulls.  A plan that asks for both fields passes once.
    """
    prepare()
    return _log_faults(logs)


def run_status(logs: Column, timed_out: Column) -> Column:
    """timeout, else startup_error where any pattern matches, else completion."""
    return F.when(timed_out, "timeout").when(log_faults(logs)["startup"], "startup_error").otherwise("completion")


def symbol_errors(logs: Column) -> Column:
    return log_faults(logs)["symbols"]


def last_number(logs: Column, pattern: Column | str) -> Column:
    """The first group of the last match as a number, or 0."""
    p = F.lit(java_pattern(pattern)) if isinstance(pattern, str) else pattern
    return F.coalesce(F.try_element_at(F.regexp_extract_all(logs, p, F.lit(1)), F.lit(-1)).cast("int"), F.lit(0))


def parsed_counts(logs: Column, parser: dict[str, str]) -> Column:
    """A map from status to count, without the statuses that have no pattern."""
    pairs = [x for status, p in parser.items() if p for x in (F.lit(status), last_number(logs, p))]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,int>")


@lru_cache(4096)
def _compiled(pattern: str) -> re.Pattern | str:
    """The pattern, or why it does not compile."""
    try:
        return re.compile(pattern, re.MULTILINE)
    except re.error as fault:
        return f"pattern {pattern!r}: {fault}"


def last_of_pattern(log: str, pattern: str, strict: bool = False) -> int:
    """The first group of the last match as a number, or 0; ValueError for a pattern or a group that is no good.

    A pattern without a group is no good where it matches; if ``strict``, anywhere.
    """
    own = _compiled(pattern)
    if isinstance(own, str):
        raise ValueError(own)
    if strict and not own.groups:
        raise ValueError(f"pattern {pattern!r}: no group")
    found = None
    for found in own.finditer(log):
        pass
    if found is None:
        return 0
    try:
        return int(found.group(1))
    except (IndexError, TypeError, ValueError) as fault:
        raise ValueError(f"pattern {pattern!r}: {fault}") from None


def parsed_by_rows(logs: Column, parser: Column, strict: bool = False) -> Column:
    """The struct (counts, fault) of each row's own map from status to pattern, in Python's dialect.

    A status without a pattern has no count; with a fault there are no counts.
    A null log is empty, a null map has no patterns.  If ``strict``, a pattern
    without a group is a fault whatever the log, as one that does not compile is.
    """
    prepare()

    @F.pandas_udf("counts map<string,int>, fault string")
    def parse(texts: pd.Series, parsers: pd.Series) -> pd.DataFrame:
        counts, faults = [], []
        for log, patterns in zip(texts, parsers, strict=True):
            try:
                counts.append({s: last_of_pattern(log or "", p, strict) for s, p in dict(patterns or ()).items() if p})
                faults.append(None)
            except ValueError as fault:
                counts.append(None)
                faults.append(str(fault))
        return pd.DataFrame({"counts": counts, "fault": faults})

    return parse(logs, parser)


def failures(counts: Column) -> Column:
    total = F.lit(0)
    for s in FAILURE_STATUSES:
        total = total + F.coalesce(F.try_element_at(counts, F.lit(s)), F.lit(0))
    return total


def valid_parser(parser: Column) -> Column:
    """Only known statuses among the patterns given, and one for failures or errors at least."""
    keys = F.map_keys(F.map_filter(parser, lambda k, v: v != ""))
    return F.forall(keys, lambda k: k.isin(ITEM_STATUSES)) & F.exists(keys, lambda k: k.isin(FAILURE_STATUSES))
