"""Scans over an order that no single task has to hold: ranges are scanned apart, and what ends one is carried into the next.

Rows are dealt by ranges of the groups and their order, sorted within, and
written to the checkpoint folder, since ranges are sampled and a second deal
could cut them elsewhere.  A first pass takes one row from each range: what its
first and its last group come to.  These are folded on the driver, one row a
range, and a second pass scans each range from what is carried into it.  So a
group of any size is split, and no rows are shuffled twice.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchloom.session import cut_lineage, free_name, prepare

#: What a scan makes of a column: all of them leave nulls out, "last" takes any type, the others numbers.
OPS = ("sum", "min", "max", "last")


def _codes(batch: pa.RecordBatch, by: Sequence[str]) -> np.ndarray:
    """True where a row's group differs from that of the row before; null is a group of its own."""
    new = np.zeros(batch.num_rows, bool)
    new[0] = True
    for c in by:
        codes = np.array(batch.column(c).dictionary_encode(null_encoding="encode").indices)
        new[1:] |= codes[1:] != codes[:-1]
    return new


def _key(batch: pa.RecordBatch, by: Sequence[str], row: int) -> tuple:
    return tuple(batch.column(c)[row].as_py() for c in by)


def _join(op: str, a: Any, b: Any) -> Any:
    """What two stretches of a group come to, the first before the second."""
    if a is None or b is None:
        return b if a is None else a
    return {"sum": lambda: a + b, "min": lambda: min(a, b), "max": lambda: max(a, b), "last": lambda: b}[op]()


def _scanned(op: str, column: pa.Array, new: np.ndarray, carry: Any) -> pa.Array:
    """The scan of a column by groups; ``carry`` goes before the first."""
    if op == "last":
        size = len(column)
        known = np.array(column.is_valid())
        at = np.maximum.accumulate(np.where(known, np.arange(size), -1))
        start = np.maximum.accumulate(np.where(new, np.arange(size), -1))
        place = np.where(at >= start, at, np.where(start == 0, size, size + 1))
        whole = pa.concat_arrays([column, pa.array([carry], column.type), pa.nulls(1, column.type)])
        return whole.take(pa.array(place))
    if pa.types.is_integer(column.type):
        values = pd.Series(column.cast(pa.int64()).to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get))
    else:
        values = column.to_pandas()
    group = np.cumsum(new)
    by = values.groupby(group)
    out = {"sum": by.cumsum, "min": by.cummin, "max": by.cummax}[op]()
    out = out.groupby(group).ffill()
    if carry is not None:
        first = group == group[0]
        held = out[first]
        joined = held + carry if op == "sum" else held.clip(upper=carry) if op == "min" else held.clip(lower=carry)
        out[first] = joined.fillna(carry)
    return pa.Array.from_pandas(out, type=column.type)


def _ends(by: Sequence[str], outs: Sequence[tuple[str, str, str]], part: str):
    """One row a range: its first and last group and what they come to there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = _codes(batch, by)
            starts = np.flatnonzero(new)
            carries = {}
            if state and state["last"] == _key(batch, by, 0):
                carries = state["end"]
            scans = {name: _scanned(op, batch.column(c), new, carries.get(name)) for name, op, c in outs}
            row = batch.num_rows - 1
            if state is None:
                state = {"part": batch.column(part)[0].as_py(), "first": _key(batch, by, 0), "alone": True}
            elif state["last"] != _key(batch, by, 0):
                state["alone"] = False
            if len(starts) > 1:
                state["alone"] = False
            state |= {"last": _key(batch, by, row), "end": {name: s[row].as_py() for name, s in scans.items()}}
        if state:
            kept = pickle.dumps((state["first"], state["last"], state["alone"], state["end"]))
            yield pa.RecordBatch.from_arrays([pa.array([state["part"]], pa.int32()), pa.array([kept], pa.binary())], ["part", "ends"])

    return run


def _carried(ends: dict[int, bytes], outs: Sequence[tuple[str, str, str]]) -> dict[int, tuple[tuple, dict]]:
    """What goes before the first group of each range, as far as the group began earlier."""
    out: dict[int, tuple[tuple, dict]] = {}
    last, end = None, None
    for part in sorted(ends):
        first, own_last, alone, own_end = pickle.loads(ends[part])
        goes_on = last is not None and last[0] == first
        if goes_on:
            out[part] = (first, end)
        if alone and goes_on:
            own_end = {name: _join(op, end[name], own_end[name]) for name, op, _ in outs}
        last, end = (own_last,), own_end
    return out


def _finish(by: Sequence[str], outs: Sequence[tuple[str, str, str]], part: str, carried, names: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, end = None, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            first = _key(batch, by, 0)
            if last is None:
                last, end = carried.value.get(batch.column(part)[0].as_py(), (None, {}))
            carries = end if last == first else {}
            new = _codes(batch, by)
            scans = [_scanned(op, batch.column(c), new, carries.get(name)) for name, op, c in outs]
            last = _key(batch, by, batch.num_rows - 1)
            end = {name: s[batch.num_rows - 1].as_py() for (name, _, _), s in zip(outs, scans, strict=True)}
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *scans], [*names, *(name for name, _, _ in outs)])

    return run


def ranged(df: DataFrame, order: Sequence[Column]) -> tuple[DataFrame, str]:
    """``df`` in sorted ranges of the order, written to the checkpoint folder, and the name of the column that numbers them."""
    part = free_name(df.columns, "part")
    return cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(part, F.spark_partition_id())), part


def scan(df: DataFrame, order: Sequence[Column | str], outs: Mapping[str, tuple[str, str]], by: Sequence[str] = ()) -> DataFrame:
    """Adds, for ``outs`` of name -> (op, column), the op over all rows of the group up to each row in the order.

    Groups are equal values of ``by``, null one of them.  Rows that the order
    does not tell apart come in any order.  Nulls are left out, so a result is
    null until the first value.  An empty table stays empty.
    """
    spark = prepare(df.sparkSession)
    wanted = [(name, op, c) for name, (op, c) in outs.items()]
    if bad := [op for _, op, _ in wanted if op not in OPS]:
        raise ValueError(f"unknown operations: {bad}")
    dealt, part = ranged(df, [*(F.col(c).asc() if isinstance(c, str) else c for c in [*by, *order])])
    needed = list(dict.fromkeys([part, *by, *(c for _, _, c in wanted)]))
    rows = dealt.select(*needed).mapInArrow(_ends(by, wanted, part), "part int, ends binary").collect()
    carried = spark.sparkContext.broadcast(_carried({r["part"]: bytes(r["ends"]) for r in rows}, wanted))
    names = [c for c in df.columns if c not in outs]
    fields = [df.schema[c] for c in names] + [T.StructField(name, df.schema[c].dataType) for name, _, c in wanted]
    return dealt.mapInArrow(_finish(by, wanted, part, carried, names), T.StructType(fields))


def numbered(df: DataFrame, order: Sequence[Column | str], out: str, by: Sequence[str] = ()) -> DataFrame:
    """Adds the row's number, from 1, in its group by the order; a group of any size is numbered by many tasks."""
    one = free_name([*df.columns, out], "one")
    return scan(df.withColumn(one, F.lit(1).cast("bigint")), order, {out: ("sum", one)}, by).drop(one)
