"""Session helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from patchloom.session import cut_lineage, free_name, prepare

__all__ = ["cut_lineage", "free_name", "prepare", "schema_of", "with_names"]


def schema_of(df: DataFrame) -> str:
    """The columns of ``df`` as a schema string."""
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema)


def with_names(df: DataFrame, names: Iterable[str], function: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``function`` of ``df`` with all its columns but ``names`` renamed c0, c1 ... so that none clashes, and named back after it.

    Columns that ``function`` adds keep their names, after those of ``df``.
    """
    names = list(names)
    short = [c if c in names else f"c{i}" for i, c in enumerate(df.columns)]
    out = function(df.toDF(*short))
    return out.toDF(*df.columns, *out.columns[len(short) :])
