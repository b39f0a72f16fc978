"""Keyed dedup, upsert, joins with order, bag difference, splits and nearest values on DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patchloom.operators import ranges
from patchloom.session import cut_lineage, free_name, prepare


def keep_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order, by a partial aggregate.

    Each column is aggregated by itself, all by the same comparisons and so from
    the same row; what a plan does not ask for is left out of the sort by keys.
    """
    rest = [c for c in df.columns if c != key]
    if not rest:
        return df.distinct()
    return df.groupBy(key).agg(*(F.min_by(c, F.struct(*order)).alias(c) for c in rest)).select(*df.columns)


def last_wins(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last row of each key, with ``__first``, the order in which the key was first met."""
    row = free_name(df.columns, "row")
    best = df.groupBy(key).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias(row), F.min(F.struct(*order)).alias("__first"))
    return best.select(f"{row}.*", "__first")


def one_of_each(df: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """One row for each of the keys: the last in ``order``, if the table has that column; else repeated keys are an error."""
    row, n = (free_name(df.columns, c) for c in ("row", "n"))
    if order is not None and order in df.columns:
        return df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.col(order)).alias(row)).select(f"{row}.*")
    single = df.groupBy(*keys).agg(F.first(F.struct(*df.columns)).alias(row), F.count("*").alias(n))
    sure = F.when(F.col(n) > 1, F.raise_error(F.concat(F.lit(f"repeated {', '.join(keys)} without an order: "), F.to_json(F.struct(*keys))))).otherwise(F.lit(True))
    return single.filter(sure).select(f"{row}.*")


def union_handlers(*frames: DataFrame) -> DataFrame:
    """All rows by column name, with ``handler_idx``, the position of their frame; missing columns are null."""
    out = frames[0].withColumn("handler_idx", F.lit(0))
    for i, f in enumerate(frames[1:], 1):
        out = out.unionByName(f.withColumn("handler_idx", F.lit(i)), allowMissingColumns=True)
    return out


def upsert(target: DataFrame, source: DataFrame, key: str, columns: Sequence[str], where: Column | None = None) -> DataFrame:
    """Sets ``columns`` of matched rows from ``source`` and inserts the others whole."""
    here = free_name([*target.columns, *source.columns], "here")
    if where is not None:
        source = source.filter(where)
    held, new = (df.withColumn(here, F.lit(True)) for df in (target, source))
    t, s = held.alias("t"), new.alias("s")
    out = []
    for c in target.columns:
        fresh = F.col(f"s.{c}") if c in source.columns else F.lit(None)
        own = F.col(f"t.{c}")
        if c == key:
            out.append(F.coalesce(own, fresh).alias(c))
        elif c in columns:
            out.append(F.when(F.col(f"s.{here}"), fresh).otherwise(own).alias(c))
        else:
            out.append(F.when(F.col(f"t.{here}"), own).otherwise(fresh).alias(c))
    return t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer").select(*out)


def update_matched(target: DataFrame, source: DataFrame, key: str, column: str) -> DataFrame:
    """Sets one column where the key is matched."""
    fresh, here = (free_name([*target.columns, *source.columns], c) for c in ("new", "here"))
    new = source.select(key, F.col(column).alias(fresh), F.lit(True).alias(here))
    kept = [c for c in target.columns if c != column]
    old = F.col(column) if column in target.columns else F.lit(None)
    return target.join(new, key, "left").select(*kept, F.when(F.col(here), F.col(fresh)).otherwise(old).alias(column))


def strict_lookup(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join that fails where a left key has no match."""
    found = free_name([*left.columns, *right.columns], "found")
    marked = left.join(right.withColumn(found, F.lit(True)), key, "left")
    return marked.withColumn(found, F.assert_true(F.col(found), "no match for a key")).drop(found)


def only_ids(df: DataFrame, key: str, ids: Sequence[str] | None) -> DataFrame:
    """Rows of the listed keys; None is all, an empty list none."""
    return df if ids is None else df.filter(F.col(key).isin(list(ids)))


def pending(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``done``."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def submitted(df: DataFrame, statuses: DataFrame, key: str, wanted: Sequence[str]) -> DataFrame:
    """Rows whose key is in the lists ``instance_ids`` of the wanted ``status`` rows."""
    ids = statuses.filter(F.col("status").isin(list(wanted))).select(F.explode("instance_ids").alias(key)).distinct()
    return df.join(ids, key, "left_semi")


def interval_semi_join(spans: DataFrame, points: DataFrame, on: Sequence[str], start: str, end: str, point: str) -> DataFrame:
    """Spans that hold any point of the same keys, by one sweep over spans and points together.

    Going down from the greatest, each span's start meets the next point at or
    after it, which is in the span or none is.  So the cost is that of sorting
    both, however many points a span holds, and a key of any size is swept in
    ranges.  Rows with a null key or bound hold nothing; repeated spans each stay.
    """
    whole = [F.col(c).isNotNull() for c in on]
    at, seen, kind = (free_name([*spans.columns, *on], c) for c in ("at", "seen", "kind"))
    first = reduce(lambda a, b: a & b, [*whole, F.col(point).isNotNull()])
    p = points.filter(first).select(*on, F.col(point).alias(at), F.col(point).alias(seen), F.lit(0).alias(kind)).dropDuplicates([*on, at])
    s = spans.filter(reduce(lambda a, b: a & b, [*whole, F.col(start).isNotNull()])).withColumns({at: F.col(start), seen: F.lit(None).cast(points.schema[point].dataType), kind: F.lit(1)})
    swept = ranges.scan(s.unionByName(p, allowMissingColumns=True), [F.col(at).desc(), kind], {seen: ("last", seen)}, on)
    return swept.filter((F.col(kind) == 1) & (F.col(seen) <= F.col(end))).select(*spans.columns)


def bag_difference(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """Rows of ``right`` beyond as many equal values as ``left`` has for the keys; order columns stay.

    Values of the left are counted by a partial aggregate and go before the
    right's of the same value, whose rows are then numbered by ranges, so a
    value that most rows have is split.  Null keys and values are equal to no
    others: all their rows stay.
    """
    names = [*right.columns, *keys, value]
    had, one, kind = (free_name(names, c) for c in ("had", "one", "kind"))
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, value]])
    counted = left.filter(whole).groupBy(*keys, value).agg(F.count("*").alias(had)).withColumns({one: F.lit(0).cast("bigint"), kind: F.lit(0)})
    rows = right.withColumns({had: F.lit(None).cast("bigint"), one: F.lit(1).cast("bigint"), kind: F.lit(1)})
    swept = ranges.scan(rows.unionByName(counted, allowMissingColumns=True), [kind, order], {had: ("last", had), one: ("sum", one)}, [*keys, value])
    return swept.filter((F.col(kind) == 1) & (F.col(one) > F.coalesce(had, F.lit(0)))).select(*right.columns)


def running_least_ratio(df: DataFrame, size: str, order: str, first: float, cap: float, by: Sequence[str] = ()) -> DataFrame:
    """Adds ``ratio``: the least so far of ``first`` and cap / size, each rounded to one digit as Python does.

    Without keys the order is that of all rows, which is scanned by ranges.
    """
    from patchloom.functions.text import round_half_even_exact

    prepare(df.sparkSession)
    term = free_name(df.columns, "term")
    sized = df.withColumn(term, round_half_even_exact(F.lit(float(cap)) / F.col(size), F.lit(1)))
    if by:
        rows = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        swept = sized.withColumn(term, F.min(term).over(rows))
    else:
        swept = ranges.scan(sized, [order], {term: ("min", term)})
    return swept.withColumn("ratio", F.least(F.lit(round(first, 1)), F.col(term))).select(*(c for c in df.columns if c != "ratio"), "ratio")


def balanced_split(df: DataFrame, n: int, order: str) -> DataFrame:
    """Adds ``bucket`` 1..n: contiguous runs in order, the first ones longer by one.

    Rows are dealt once by ranges of the order and written to the checkpoint
    folder, since ranges are sampled and a second deal could cut them elsewhere.
    Positions come from a count per range, one row each, so the rows are sorted
    in as many tasks as there are, not in one.
    """
    part, place, size, base, total = (free_name(df.columns, c) for c in ("part", "place", "size", "base", "total"))
    ranged = cut_lineage(df.repartitionByRange(order).withColumn(part, F.spark_partition_id()))
    counts = ranged.groupBy(part).agg(F.count("*").alias(size))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn(base, F.coalesce(F.sum(size).over(earlier), F.lit(0))).withColumn(total, F.sum(size).over(Window.partitionBy()))
    placed = ranged.withColumn(place, F.row_number().over(Window.partitionBy(part).orderBy(order)))
    joined = placed.join(F.broadcast(counts), part)
    at = F.col(base) + F.col(place) - 1
    small, extra = F.floor(F.col(total) / n), F.col(total) % n
    long_rows = extra * (small + 1)
    bucket = F.when(at < long_rows, F.floor(at / (small + 1))).otherwise(extra + F.floor((at - long_rows) / F.greatest(small, F.lit(1))))
    return joined.select(*(c for c in df.columns if c != "bucket"), (bucket + 1).cast("int").alias("bucket"))


def nearest(value: Column, candidates: Sequence[float]) -> Column:
    """The candidate of least distance, the first of equals."""
    ranked = F.array(*(F.struct(F.abs(value - F.lit(c)).alias("d"), F.lit(i).alias("i"), F.lit(c).alias("v")) for i, c in enumerate(candidates)))
    return F.array_min(ranked)["v"]


def nearest_version(version: Column, available: Sequence[str]) -> Column:
    """The version itself if available, else the nearest by its number."""
    from patchloom.functions.text import clean_version, version_number

    wanted = clean_version(version)
    mine = version_number(wanted)
    ranked = F.array(*(F.struct(F.abs(mine - version_number(F.lit(v))).alias("d"), F.lit(i).alias("i"), F.lit(v).alias("v")) for i, v in enumerate(available)))
    return F.when(wanted.isin(list(available)), wanted).otherwise(F.array_min(ranked)["v"])


def page(df: DataFrame, order: str, offset: int = 0, limit: int | None = None) -> DataFrame:
    out = df.orderBy(order).offset(offset)
    return out if limit is None else out.limit(limit)


def prefix_match(df: DataFrame, prefixes: DataFrame, on: str, value: str, prefix: str, out: str) -> DataFrame:
    """Adds whether the value starts with any prefix of the same key.

    Distinct values are cut at the lengths that the key's prefixes have, and
    joined with the prefixes on equal cuts, so no row holds a key's prefixes
    and a key with most of them is split by cut.  Nulls match nothing.
    """
    key, text, cut, size = (free_name([*df.columns, on, value], c) for c in ("key", "text", "cut", "size"))
    known = prefixes.select(F.col(on).alias(key), F.col(prefix).alias(cut)).dropna().distinct()
    lengths = known.groupBy(key).agg(F.collect_set(F.length(cut)).alias(size))
    values = df.select(F.col(on).alias(key), F.col(value).alias(text)).dropna().distinct().join(lengths, key)
    cuts = values.select(key, text, F.explode(F.filter(size, lambda n: n <= F.length(text))).alias(size)).withColumn(cut, F.left(text, F.col(size)))
    found = cuts.join(known, [key, cut], "left_semi").select(key, text).distinct().withColumn(cut, F.lit(True))
    same = (F.col(on) == F.col(key)) & (F.col(value) == F.col(text))
    return df.drop(out).join(found, same, "left").withColumn(out, F.coalesce(cut, F.lit(False))).drop(key, text, cut)


def carried_header(df: DataFrame, header: Column, keys: Sequence[str], order: str, out: str) -> DataFrame:
    """Adds the last non-null header at or before each row."""
    rows = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.last(header, ignorenulls=True).over(rows))
