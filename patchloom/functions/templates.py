"""Templates with values, loops and conditions, compiled to column expressions.

``{{ name }}`` and ``{{ item.field }}`` put a value, ``{% for item in name %}``
to ``{% endfor %}`` repeats over an array column, ``{% if name %}`` to ``{% else
%}`` and ``{% endif %}`` chooses; ``{{ "text" if condition }}`` is the short
form.  In a loop ``loop.index``, ``loop.first`` and ``loop.last`` are known.  A
minus at a tag's brace takes the white space beside it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

TAG = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?.*?-?%\})", re.DOTALL)
SHORT = re.compile(r"""("[^"]*"|'[^']*')\s+if\s+(.+)""", re.DOTALL)
FOR = re.compile(r"for\s+(\w+)\s+in\s+([\w.]+)")

Scope = Mapping[str, Column]
Part = Callable[[Scope], Column]


def _pieces(template: str) -> list[tuple[str, str]]:
    """(kind, text) of texts, values and blocks, white space taken where a tag says so; one line end at the end goes."""
    raw = TAG.split(template[:-1] if template.endswith("\n") else template)
    out = []
    for i, piece in enumerate(raw):
        if i % 2:
            out.append(("value" if piece[1] == "{" else "block", piece[2:-2].removeprefix("-").removesuffix("-").strip()))
            continue
        if i and raw[i - 1][-3] == "-":
            piece = piece.lstrip()
        if i + 1 < len(raw) and raw[i + 1][2] == "-":
            piece = piece.rstrip()
        out.append(("text", piece))
    return out


def _value(name: str, scope: Scope) -> Column:
    """A quoted text, or a name with its fields."""
    if name[:1] in "\"'":
        return F.lit(name[1:-1])
    if name in scope:
        return scope[name]
    first, _, rest = name.partition(".")
    if first not in scope:
        raise ValueError(f"the template has no value for {name}")
    column = scope[first]
    for field in rest.split(".") if rest else []:
        column = column[field]
    return column


def _truth(text: str, scope: Scope) -> Column:
    """A condition: ``not``, and a name that is true, not empty and not null."""
    if text.startswith("not "):
        return ~_truth(text[4:].strip(), scope)
    if text in ("loop.last", "loop.first"):
        return scope[text]
    value = _value(text, scope).cast("string")
    return F.coalesce(~value.isin("", "false", "0", "[]"), F.lit(False))


def _put(text: str) -> Part:
    if m := SHORT.fullmatch(text):
        return lambda scope: F.when(_truth(m[2].strip(), scope), F.lit(m[1][1:-1])).otherwise("")
    return lambda scope: F.coalesce(_value(text, scope).cast("string"), F.lit("None"))


def _joined(parts: list[Part], scope: Scope) -> Column:
    return F.concat(F.lit(""), *(p(scope) for p in parts))


def _loop(text: str, body: list[Part]) -> Part:
    m = FOR.fullmatch(text)
    if not m:
        raise ValueError(f"not a loop: {text}")

    def part(scope: Scope) -> Column:
        array = _value(m[2], scope)

        def each(x: Column, i: Column) -> Column:
            return _joined(body, {**scope, m[1]: x, "loop.index": i + 1, "loop.first": i == 0, "loop.last": i == F.size(array) - 1})

        return F.coalesce(F.array_join(F.transform(array, each), ""), F.lit(""))

    return part


def _choice(text: str, body: list[Part], other: list[Part]) -> Part:
    return lambda scope: F.when(_truth(text, scope), _joined(body, scope)).otherwise(_joined(other, scope))


def _until(pieces: list[tuple[str, str]], ends: tuple[str, ...]) -> tuple[list[Part], str]:
    """The parts up to a block of ``ends``, which is taken from ``pieces``."""
    parts: list[Part] = []
    while pieces:
        kind, text = pieces.pop(0)
        word = text.split(" ", 1)[0] if kind == "block" else ""
        if kind == "text":
            parts.append(lambda scope, text=text: F.lit(text))
        elif kind == "value":
            parts.append(_put(text))
        elif word in ends:
            return parts, word
        elif word == "for":
            parts.append(_loop(text, _until(pieces, ("endfor",))[0]))
        elif word == "if":
            body, end = _until(pieces, ("else", "endif"))
            other = _until(pieces, ("endif",))[0] if end == "else" else []
            parts.append(_choice(text[3:].strip(), body, other))
        else:
            raise ValueError(f"unknown block: {text}")
    if ends:
        raise ValueError(f"no {ends[-1]}")
    return parts, ""


def rendered(template: str, values: Mapping[str, Column]) -> Column:
    """The template as one expression over the columns; a null value is None, a null array is empty."""
    return _joined(_until(_pieces(template), ())[0], dict(values))
