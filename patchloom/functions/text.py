"""Column functions on identifiers, paths, versions and lines."""

from __future__ import annotations

import decimal
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchloom.schemas import LANGUAGE_EXTENSIONS
from patchloom.session import prepare

LINE_ENDS = r"\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
LINE_END = rf"\r\n|[{LINE_ENDS}]"


#: So many tokens before the wanted ones are encoded with them, so that a cut before has no part in theirs.
TAIL_SPARE = 64


def split_lines(text: Column) -> Column:
    """Lines without their ends; every Unicode line end parts, and a last end adds no empty line."""
    parts = F.split(text, LINE_END, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def instance_id(project: Column, commit: Column) -> Column:
    return F.concat(F.replace(project, F.lit("/"), F.lit("__")), F.lit("_"), commit)


def instance_commit(instance: Column) -> Column:
    return F.substring_index(instance, "_", -1)


def instance_project(instance: Column) -> Column:
    """The project; all double underscores become slashes, also those a project had of its own."""
    return F.replace(F.left(instance, F.length(instance) - F.length(instance_commit(instance)) - 1), F.lit("__"), F.lit("/"))


def short_id(instance: Column) -> Column:
    return F.left(instance_commit(instance), F.lit(7))


def hub_image_name(instance: Column, user: str, family: str, arch: str = "x86_64") -> Column:
    """The evaluation image's name on a hub: its user, the family and architecture, and the instance in lower case."""
    return F.concat(F.lit(f"{user}/{family}.{arch}.eval_"), F.lower(F.replace(instance, F.lit("__"), F.lit("_"))))


def model_dir(model: Column) -> Column:
    return F.replace(F.coalesce(model, F.lit("none")), F.lit("/"), F.lit("__"))


def suffix(path: Column) -> Column:
    """The last extension of the base name, with its dot; none for names that only start with a dot."""
    name = F.substring_index(path, "/", -1)
    last = F.substring_index(name, ".", -1)
    return F.when((F.length(name) > F.length(last) + 1) & (last != ""), F.concat(F.lit("."), last)).otherwise(F.when(path.isNotNull(), ""))


def has_keyword(path: Column, keywords: list[str]) -> Column:
    """Whether the lower-cased path, folders included, contains any keyword."""
    low = F.lower(path)
    found = F.lit(False)
    for k in keywords:
        found = found | F.contains(low, F.lit(k))
    return found


def of_language(path: Column, language: str) -> Column:
    return suffix(path).isin(LANGUAGE_EXTENSIONS.get(language, []))


def known_code(path: Column) -> Column:
    return suffix(path).isin(sorted({e for own in LANGUAGE_EXTENSIONS.values() for e in own}))


def clean_version(version: Column) -> Column:
    """Digits and dots of the first two parts."""
    return F.substring_index(F.regexp_replace(version, r"[^0-9.]", ""), ".", 2)


def version_number(version: Column) -> Column:
    """Parts weighed by powers of 100 from the right; an empty part is an error."""
    return F.aggregate(F.split(version, r"\."), F.lit(0).cast("bigint"), lambda acc, part: acc * 100 + part.cast("bigint"))


def tail_words(text: Column, n: int) -> Column:
    """The last ``n`` words of a text, joined by single spaces."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    return F.array_join(F.slice(words, F.greatest(F.lit(1), F.size(words) - (n - 1)), n), " ")


@lru_cache(4)
def _tokenizer(path: str):
    """A tokenizer file, read once by each worker."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _tail(text: str, tokenizer, n: int) -> str:
    """The end of a text from its n-th last token on; only as much of the end is encoded as has enough tokens.

    An end is cut where a word starts after white space and a line end, which
    the tokenizers' own splitting respects, with some tokens to spare before.
    """
    if not n:
        return ""
    size = max(4096, 16 * n)
    while size < len(text):
        cut = text.rfind("\n", 0, len(text) - size) + 1
        if cut and not text[cut].isspace():
            offsets = tokenizer.encode(text[cut:], add_special_tokens=False).offsets
            if len(offsets) > n + TAIL_SPARE:
                return text[cut + offsets[-n][0] :]
        size *= 4
    offsets = tokenizer.encode(text, add_special_tokens=False).offsets
    return text if len(offsets) <= n else text[offsets[-n][0] :]


def tail_tokens(text: Column, tokenizer_path: str, n: int) -> Column:
    """The end of a text from where its last ``n`` tokens start; the whole text if it has no more.

    ``tokenizer_path`` names a tokenizer file that all workers can read.
    """
    prepare()

    @F.pandas_udf(T.StringType())
    def tail(texts: pd.Series) -> pd.Series:
        tokenizer = _tokenizer(tokenizer_path)
        return pd.Series([None if t is None else _tail(t, tokenizer, n) for t in texts], dtype=object)

    return tail(text)


def year_of_cve(cve: Column, strict: bool = False) -> Column:
    part = F.split_part(cve, F.lit("-"), F.lit(2))
    return part.cast("int") if strict else part.try_cast("int")


@F.pandas_udf(T.DoubleType())
def round_half_even_exact(x: pd.Series, digits: pd.Series) -> pd.Series:
    """Rounds the exact binary value of a double, ties to even."""
    places = [decimal.Decimal(1).scaleb(-int(d)) for d in digits]
    return pd.Series([None if v is None or v != v else float(decimal.Decimal(float(v)).quantize(p, rounding=decimal.ROUND_HALF_EVEN)) for v, p in zip(x, places, strict=True)], dtype="float64")
