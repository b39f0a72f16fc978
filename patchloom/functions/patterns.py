"""Sets of patterns that are looked for in one pass: an automaton of the literals they need, full expressions only after a hit."""

from __future__ import annotations

import re
from collections.abc import Sequence

import ahocorasick

#: A piece of a pattern: an escape, a class, the start of a group, a quantifier, or one character.
PIECE = re.compile(r"\\.|\[\^?\]?[^\]]*\]|\(\?(?:P?<\w+>|[:=!]|<[=!])|[*+?]\??|\{\d*,?\d*\}\??|.", re.DOTALL)
#: A literal that is shorter tells too little to look for it.
LEAST = 3


def literal_of(pattern: str) -> str:
    """The longest text that any match of the pattern holds, or none where there is a choice at its top."""
    runs, run, depth = [], "", 0
    for piece in PIECE.findall(pattern):
        if piece == ")":
            depth -= 1
        elif piece.startswith("("):
            runs.append(run)
            run, depth = "", depth + 1
        elif depth:
            continue
        elif piece == "|":
            return ""
        elif piece[0] in "*?{":
            runs.append(run[:-1])
            run = ""
        elif len(piece) == 2 and piece[0] == "\\" and (piece[1] in "rnt" or not piece[1].isalnum()):
            run += {"r": "\r", "n": "\n", "t": "\t"}.get(piece[1], piece[1])
        elif len(piece) == 1 and piece not in ".^$+":
            run += piece
        else:
            runs.append(run)
            run = ""
    return max([*runs, run], key=len)


class PatternSet:
    """Multi-line patterns in Python's dialect; ``possible`` passes over a text once."""

    def __init__(self, patterns: Sequence[str]) -> None:
        self.compiled = [re.compile(p, re.MULTILINE) for p in patterns]
        self.anchored = [p.startswith(r"\A") for p in patterns]
        self.always: list[int] = []
        needed: dict[str, list[int]] = {}
        for i, p in enumerate(patterns):
            literal = literal_of(p)
            if len(literal) < LEAST:
                self.always.append(i)
            else:
                needed.setdefault(literal, []).append(i)
        self.words = ahocorasick.Automaton()
        for literal, own in needed.items():
            self.words.add_word(literal, own)
        if needed:
            self.words.make_automaton()
        self.size = len(needed)

    def possible(self, text: str) -> list[int]:
        """The patterns whose literal the text has, and those without one."""
        found: set[int] = set(self.always)
        if self.size:
            for _, own in self.words.iter(text):
                found.update(own)
                if len(found) == len(self.compiled):
                    break
        return sorted(found)

    def any(self, text: str, among: Sequence[int]) -> bool:
        """Whether any of the patterns matches somewhere."""
        return any((self.compiled[i].match if self.anchored[i] else self.compiled[i].search)(text) is not None for i in among)

    def count(self, text: str, among: Sequence[int]) -> int:
        """All matches of the patterns, each pattern's without overlap."""
        return sum(1 for i in among for _ in self.compiled[i].finditer(text))
