"""License scans: lines and runs of words compared to licence texts by Dice coefficient over word bigrams.

A line's text is normalised (lower case, anything but letters, digits and dots
is a space); its distinct bigrams are hashed, if it has any of the words that
every match has one of.  A notice is compared only if the numbers of bigrams
allow the threshold at all.

What no single line shows (notices wrapped over lines or inside a paragraph,
and whole licence texts) is found in the normalised text as a whole.  A licence
is looked for only where the text has as many of its bigrams as any run at the
threshold must have; then the run for which twice the hits less the threshold
times the bigrams is greatest is scored.  Everything is built from DataFrame
functions on the rows as they are read; one aggregate per document follows.
"""

from __future__ import annotations

import math
import pkgutil
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

THRESHOLD = 0.7

#: Short notices and opening clauses of well-known licences.
NOTICES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    "mit": "Released under the MIT License.",
    "mit-permission": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "all-rights-reserved": "All rights reserved.",
}

#: Whole licence texts, compared to runs of words besides the notices.
TEXTS = ["apache-2.0", "bsd-3-clause", "cc0-1.0", "gpl-2.0", "gpl-3.0", "lgpl-2.1", "lgpl-3.0", "mit", "mpl-2.0"]


def full_texts() -> dict[str, str]:
    return {f"{name}-text": pkgutil.get_data(__package__, f"licences/{name}-text.txt").decode() for name in TEXTS}


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^a-z0-9.]+", " "))


def notice_table(spark: SparkSession, notices: dict[str, str]) -> list[tuple[str, list[int], list[str]]]:
    """Each notice's distinct bigram hashes, made by the same expressions as a line's, and its words."""
    listed = F.array(*(F.struct(F.lit(k).alias("id"), F.lit(v).alias("text")) for k, v in sorted(notices.items())))
    rows = spark.range(1).select(F.inline(listed)).select("id", F.split(normalised(F.col("text")), " ").alias("w"))
    return [(r["id"], r["grams"], r["w"]) for r in rows.select("id", "w", _bigrams().alias("grams")).collect()]


def least_hits(grams: int, threshold: float) -> int:
    """The distinct bigrams that any match of a notice of ``grams`` must share with it."""
    return math.ceil(threshold / (2 - threshold) * grams - 1e-9)


def marking_words(texts: list[list[str]], threshold: float) -> set[str]:
    """Words of which every match of any of the texts has one: the bigrams without them are too few for a match.

    Long words come first, as they are rarer.
    """
    marks: set[str] = set()
    for words in sorted(texts, key=len):
        grams = set(zip(words, words[1:], strict=False))
        need = max(least_hits(len(grams), threshold), 1)
        open_ = {g for g in grams if marks.isdisjoint(g)}
        while len(open_) >= need:
            counts = Counter(w for g in open_ for w in set(g))
            best = max(counts, key=lambda w: (len(w) > 4, counts[w], w))
            marks.add(best)
            open_ = {g for g in open_ if best not in g}
    return marks


def _marked(marks: set[str]) -> Column:
    """Whether the words have any of the marks, which Spark looks up in a hash set."""
    return F.expr(f"exists(w, x -> x IN ({', '.join(repr(m) for m in sorted(marks))}))")


def _bigrams() -> Column:
    n = F.size("w") - 1
    return F.array_distinct(F.zip_with(F.slice("w", 1, F.greatest(n, F.lit(0))), F.slice("w", 2, F.greatest(n, F.lit(0))), lambda a, b: F.xxhash64(a, b)))


def best_notices(docs: DataFrame, notices: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per line: ``doc_id``, and the best notice with its score where one meets the threshold."""
    named = notice_table(docs.sparkSession, notices or NOTICES)
    table = [(name, grams) for name, grams, _ in named]
    marks = marking_words([w for _, _, w in named], threshold)
    least = min(threshold / (2 - threshold) * len(g) for _, g in table)
    lines = docs.select("doc_id", F.explode_outer(F.split(F.col("text").cast("string"), "\n", -1)).alias("line"))
    words = lines.select("doc_id", F.split(normalised(F.col("line")), " ").alias("w"))
    grams = words.select("doc_id", F.when((F.size("w") - 1 >= least) & _marked(marks), _bigrams()).alias("grams"), F.col("w").isNotNull().alias("is_line"))
    sized = grams.select("doc_id", "is_line", "grams", F.size("grams").alias("n"))
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    sizes = [len(g) for _, g in table]
    known = F.array(*(F.struct(F.lit(name).alias("id"), F.lit(len(g)).alias("size"), F.array(*(F.lit(x) for x in g)).alias("grams")) for name, g in table))
    fitting = F.filter(known, lambda k: F.col("n").between(k["size"] * low, k["size"] * high))
    compared = F.transform(fitting, lambda k: F.struct((2.0 * F.size(F.array_intersect("grams", k["grams"])) / (F.col("n") + k["size"])).alias("score"), k["id"].alias("id")))
    best = sized.select("doc_id", "is_line", F.when(F.col("n").between(low * min(sizes), high * max(sizes)), F.array_max(compared)).alias("best"))
    return best.select("doc_id", "is_line", F.when(F.col("best.score") >= threshold, F.col("best")).alias("best"))


def _longs(values) -> Column:
    """A constant array, as one expression however long it is."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _among(column: str, values: list[int]) -> Column:
    """The elements of an array that are any of very many numbers, as one parsed list, which Spark makes a hash set of."""
    return F.expr(f"filter({column}, x -> x IN ({', '.join(f'{v}L' for v in values)}))")


def _hits_of(table: list[tuple[str, list[int]]]) -> Column:
    """The (gram, place) of the text's bigrams that the licence ``k`` has, each licence's bigrams a hash set of their own."""
    found = "filter(transform(grams, (g, i) -> CASE WHEN g IN ({}) THEN named_struct('gram', g, 'place', i) END), x -> x IS NOT NULL)"
    cases = " ".join(f"WHEN '{name}' THEN {found.format(', '.join(f'{v}L' for v in grams))}" for name, grams in table)
    return F.expr(f"CASE k.id {cases} END")


def _with_previous(hits: Column) -> Column:
    """(place, before) in order of place: where the same bigram was met last, by sorting and comparing neighbours."""
    by_gram = F.array_sort(hits)
    shifted = F.concat(F.array(F.lit(None).cast("struct<gram:bigint,place:int>")), F.slice(by_gram, 1, F.greatest(F.size(by_gram) - 1, F.lit(0))))
    return F.array_sort(F.zip_with(by_gram, shifted, lambda x, y: F.struct(x["place"].alias("place"), F.when(x["gram"] == y["gram"], y["place"]).alias("before"))))


def _best_run(at: Column, threshold: float) -> Column:
    """First and last place of the run of bigrams with the greatest sum, from the hits ``at (place, before)``, in one pass.

    The sum is twice the distinct hits less ``threshold`` times the bigrams,
    where a hit that the run has already adds nothing; a run whose sum the gap
    before a hit uses up starts anew at the hit.
    """
    gain, start = 2.0 - threshold, F.struct(F.lit(0.0).alias("sum"), F.lit(-1).alias("start"), F.lit(-1).alias("at"), F.lit(0.0).alias("best"), F.lit(0).alias("first"), F.lit(-1).alias("last"))

    def step(state: Column, hit: Column) -> Column:
        place = hit["place"]
        left = state["sum"] - threshold * (place - state["at"] - 1)
        anew = (state["start"] < 0) | (left <= 0)
        again = F.coalesce(hit["before"] >= state["start"], F.lit(False))
        total = F.when(anew, F.lit(gain)).otherwise(left + F.when(again, F.lit(0.0)).otherwise(F.lit(gain)))
        return F.struct(total.alias("sum"), F.when(anew, place).otherwise(state["start"]).alias("start"), place.alias("at"), state["best"].alias("best"), state["first"].alias("first"), state["last"].alias("last"))

    def keep(state: Column) -> Column:
        more = state["sum"] > state["best"]
        return F.struct(state["sum"].alias("sum"), state["start"].alias("start"), state["at"].alias("at"), F.when(more, state["sum"]).otherwise(state["best"]).alias("best"), F.when(more, state["start"]).otherwise(state["first"]).alias("first"), F.when(more, state["at"]).otherwise(state["last"]).alias("last"))

    return F.aggregate(at, start, lambda state, hit: F.get(F.transform(F.array(step(state, hit)), keep), F.lit(0)))


def best_runs(docs: DataFrame, notices: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id`` and, for each licence that a run of its words meets the threshold for, the name and the score."""
    named = notice_table(docs.sparkSession, (notices or NOTICES) | full_texts())
    table = [(name, grams) for name, grams, _ in named if grams]
    marks = marking_words([w for _, grams, w in named if grams], threshold)
    known = F.array(*(F.struct(F.lit(name).alias("id"), F.lit(len(g)).alias("size"), F.lit(least_hits(len(g), threshold)).alias("need"), _longs(g).alias("grams")) for name, g in table))
    every = sorted({x for _, g in table for x in g})
    words = docs.select("doc_id", F.split(normalised(F.col("text").cast("string")), " ").alias("w"))
    n = F.size("w") - 1
    grams = words.select("doc_id", F.when(_marked(marks), F.zip_with(F.slice("w", 1, F.greatest(n, F.lit(0))), F.slice("w", 2, F.greatest(n, F.lit(0))), lambda a, b: F.xxhash64(a, b))).alias("grams"))
    hits = grams.select("doc_id", "grams", F.array_distinct(_among("grams", every)).alias("hits"))
    named = hits.select("doc_id", "grams", F.explode_outer(F.filter(known, lambda k: F.when(F.size("hits") >= k["need"], F.size(F.array_intersect("hits", k["grams"])) >= k["need"]).otherwise(F.lit(False)))).alias("k")).filter("k is not null")
    places = named.select("doc_id", "grams", "k", _with_previous(_hits_of(table)).alias("at"))
    runs = places.select("doc_id", "grams", "k", _best_run(F.col("at"), threshold).alias("run"))
    cut = runs.select("doc_id", "k", F.array_distinct(F.slice("grams", F.col("run.first") + 1, F.col("run.last") - F.col("run.first") + 1)).alias("run"))
    score = 2.0 * F.size(F.array_intersect("run", "k.grams")) / (F.size("run") + F.col("k.size"))
    return cut.select("doc_id", F.col("k.id").alias("id"), score.alias("score")).filter(F.col("score") >= threshold)


def scan(docs: DataFrame, notices: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Per ``doc_id``: lines, notices, the licences found and the best score (0 if none).

    Notices are the lines that are one, and each licence that only a run of
    words shows: over several lines, within a line, or the whole text.  Of
    notices with one score, the line gets the greatest name.  A null text has
    no lines, an empty one has one; lines of a single word have no bigrams and
    match nothing.  Rows that share a ``doc_id`` (null is one, too) are scanned
    together into one row.  Other columns are not read; an empty table gives no
    rows.
    """
    runs = best_runs(docs, notices, threshold).select("doc_id", F.struct("id", "score").alias("run"))
    found = best_notices(docs, notices, threshold).unionByName(runs, allowMissingColumns=True).groupBy("doc_id").agg(
        F.count_if("is_line").alias("n_lines"),
        F.count("best").alias("n_lines_found"),
        F.collect_set("best.id").alias("ids"),
        F.max("best.score").alias("score"),
        F.collect_set("run").alias("runs"),
    )
    more = found.withColumn("runs", F.filter("runs", lambda r: ~F.array_contains("ids", r["id"])))
    return more.select(
        "doc_id",
        "n_lines",
        (F.col("n_lines_found") + F.size(F.array_distinct("runs.id"))).alias("n_notices"),
        F.array_join(F.array_sort(F.array_union("ids", "runs.id")), ",").alias("licenses"),
        F.round(F.coalesce(F.greatest("score", F.array_max("runs.score")), F.lit(0.0)), 6).alias("best_score"),
    )


def oracle_sql(notices: dict[str, str] | None = None, threshold: float = THRESHOLD) -> str:
    quoted = ", ".join(f"('{k}', '{v}')" for k, v in sorted((notices or NOTICES).items()))
    words = "string_split(trim(regexp_replace(lower({}), '[^a-z0-9.]+', ' ', 'g')), ' ')"
    grams = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""
WITH notices AS (
  SELECT id, {grams} AS g FROM (SELECT id, {words.format('t')} AS w FROM (VALUES {quoted}) v(id, t))
), lines AS (
  SELECT doc_id, row_number() OVER () AS line, {grams} AS g
  FROM (SELECT doc_id, {words.format('line')} AS w FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents))
), scored AS (
  SELECT l.doc_id, l.line, max({{'score': 2.0::DOUBLE * len(list_intersect(l.g, n.g)) / (len(l.g) + len(n.g)), 'id': n.id}}) AS best
  FROM lines l JOIN notices n ON len(l.g) BETWEEN {threshold / (2 - threshold)} * len(n.g) AND {(2 - threshold) / threshold} * len(n.g)
  GROUP BY l.doc_id, l.line
), kept AS (SELECT * FROM scored WHERE best.score >= {threshold})
SELECT l.doc_id, count(*) AS n_lines, count(k.line) AS n_notices,
       coalesce(string_agg(DISTINCT k.best.id, ',' ORDER BY k.best.id), '') AS licenses,
       round(coalesce(max(k.best.score), 0.0::DOUBLE), 6) AS best_score
FROM lines l LEFT JOIN kept k ON l.line = k.line GROUP BY l.doc_id
"""
