"""String functions as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The escapes of the installer scripts' strings.
ESCAPES = (("$\\n", "\n"), ("$\\r", "\r"), ("$\\t", "\t"), ("$$", "$"))


def str_case(s: Column, kind: str) -> Column:
    """U upper, L lower, T title, S sentence, <> swapped."""
    if kind == "U":
        return F.upper(s)
    if kind == "L":
        return F.lower(s)
    if kind == "T":
        return F.initcap(s)
    if kind == "S":
        return F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substring(s, 2, 1 << 30)))
    if kind == "<>":
        lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        return F.translate(s, lower + upper, upper + lower)
    raise ValueError(f"unknown case {kind!r}")


def str_loc(s: Column, sub: str, from_end: bool = False) -> Column:
    """Characters before the first find from the left, or after the first from the right; null if there is none."""
    if not from_end:
        at = F.instr(s, F.lit(sub)) if sub else F.lit(0)
        return F.when(at > 0, at - 1)
    at = F.instr(F.reverse(s), F.lit(sub[::-1]))
    return F.when(at > 0, at - 1)


def str_rep(s: Column, old: str, new: str) -> Column:
    return F.replace(s, F.lit(old), F.lit(new))


def str_sort(s: Column, sep: str, keep_duplicates: bool = True) -> Column:
    parts = F.split(s, re.escape(sep), -1)
    return F.array_join(F.array_sort(parts if keep_duplicates else F.array_distinct(parts)), sep)


def str_str(s: Column, sub: str) -> Column:
    """The text from the first find on."""
    at = F.instr(s, F.lit(sub))
    return F.when(at > 0, F.substring(s, at, F.length(s)))


def str_str_adv(s: Column, sub: str, from_end: bool = False, after: bool = True, keep: bool = True, loops: int = 0) -> Column:
    """The side of the (loops + 1)-th find, with or without the find itself."""
    n = F.lit(loops + 1)
    before = F.substring_index(s, sub, -(loops + 1)) if from_end else F.substring_index(s, sub, loops + 1)
    there = F.size(F.split(s, re.escape(sub), -1)) > n
    if from_end:
        right = before
        left = F.substring(s, F.lit(1), F.length(s) - F.length(right) - len(sub))
    else:
        left = before
        right = F.substring(s, F.length(left) + len(sub) + 1, F.length(s))
    out = right if after else left
    if keep:
        out = F.concat(F.lit(sub), out) if after else F.concat(out, F.lit(sub))
    return F.when(there, out)


def str_tok(s: Column, separators: str, n: int, skip_empty: bool = True) -> Column:
    """The n-th token (from 0; negative from the end) between any of the separator characters."""
    parts = F.split(s, "[" + re.escape(separators) + "]", -1)
    parts = F.filter(parts, lambda x: x != "") if skip_empty else parts
    return F.get(parts, F.lit(n)) if n >= 0 else F.try_element_at(parts, F.lit(n))


def trim_newlines(s: Column) -> Column:
    return F.regexp_replace(s, r"[\r\n]+\z", "")


def escape(s: Column) -> Column:
    for code, char in reversed(ESCAPES):
        s = F.replace(s, F.lit(char), F.lit(code))
    return s


def unescape(s: Column) -> Column:
    out = F.replace(s, F.lit("$$"), F.lit("\0"))
    for code, char in ESCAPES[:-1]:
        out = F.replace(out, F.lit(code), F.lit(char))
    return F.replace(out, F.lit("\0"), F.lit("$"))


def transliterate(s: Column, table: dict[str, str], default: str = "?") -> Column:
    """Characters by the table; other characters beyond ASCII become the default."""
    for k, v in table.items():
        s = F.replace(s, F.lit(k), F.lit(v))
    return F.regexp_replace(s, r"[^\x00-\x7F]", default)
