"""One pattern, three engines: Java for Spark, RE2 for DuckDB, Python for exact offsets."""

from __future__ import annotations

import re

#: White space, digits and word characters by Unicode, as RE2 must be told them.
_RE2 = {r"\s": r"\t\n\x0b\f\r \x{85}\p{Z}", r"\d": r"\p{Nd}", r"\w": r"\p{L}\p{M}\p{Nd}\p{Pc}"}


def alternation(patterns: list[str]) -> str:
    return "|".join(patterns)


def first_chars(pattern: str) -> str:
    """What a match of the pattern can begin with, as the inside of a character class. The pattern must begin with a
    character, an escape or a class that is not optional."""
    if pattern[0] == "[":
        end = pattern.index("]", 2)
        return pattern[1:end]
    head = pattern[:2] if pattern[0] == "\\" else pattern[0]
    if head in ("(", ".", "^", "$") or pattern[len(head) : len(head) + 1] in ("?", "*"):
        raise ValueError(f"no fixed beginning: {pattern}")
    return head


def guarded(patterns: list[str]) -> str:
    """The alternation behind a look at the next character: Java tries every alternative at every place of a text, so one
    class that says where none can begin saves most of the work. It matches what the alternation matches."""
    chars = "".join(first_chars(p) for p in patterns)
    return f"(?=[{chars}])(?:{alternation(patterns)})"


def java(pattern: str, ignore_case: bool = True, dotall: bool = False) -> str:
    """With Unicode classes and case; '.' stops at a line feed only, as in Python."""
    return f"(?{'i' * ignore_case}Ud{'s' * dotall}){pattern}"


def re2(pattern: str, ignore_case: bool = True, dotall: bool = False) -> str:
    out, inside, i = [], False, 0
    while i < len(pattern):
        two = pattern[i : i + 2]
        if two in _RE2:
            out.append(_RE2[two] if inside else f"[{_RE2[two]}]")
            i += 2
        elif two[0] == "\\":
            out.append(two)
            i += 2
        else:
            inside = two[0] == "[" or inside and two[0] != "]"
            out.append(two[0])
            i += 1
    flags = "i" * ignore_case + "s" * dotall
    return f"(?{flags})" * bool(flags) + "".join(out)


def sql(pattern: str, **kw) -> str:
    """A DuckDB string literal of the pattern."""
    return "'" + re2(pattern, **kw).replace("'", "''") + "'"


def python(pattern: str, ignore_case: bool = True, dotall: bool = False) -> re.Pattern:
    return re.compile(pattern, re.IGNORECASE * ignore_case | re.DOTALL * dotall)
