"""Word lists inside strings."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _parts(s: Column, sep: str) -> Column:
    return F.filter(F.split(s, re.escape(sep), -1), lambda w: w != "")


def word_count(s: Column, sep: str) -> Column:
    return F.size(_parts(s, sep))


def word_find(s: Column, sep: str, option: str) -> Column:
    """+n or -n: that word from the front or the back; #: how many; /text: its number; \\text: the words up to the find; * as count of separators."""
    parts = _parts(s, sep)
    if option == "#":
        return F.size(parts).cast("string")
    if option == "*":
        return F.size(F.split(s, re.escape(sep), -1)).cast("string")
    if option.startswith("/"):
        at = F.array_position(parts, option[1:])
        return F.when(at > 0, at.cast("string")).otherwise(s)
    n = int(option)
    return F.coalesce(F.try_element_at(parts, F.lit(n)), s)


def between(s: Column, left: str, right: str, n: int = 1) -> Column:
    """The n-th shortest text between two delimiters."""
    found = F.regexp_extract_all(s, F.lit(f"(?s){re.escape(left)}(.*?){re.escape(right)}"), F.lit(1))
    return F.try_element_at(found, F.lit(n))


def between_with(s: Column, left: str, centre: str, right: str, n: int = 1) -> Column:
    """The n-th text between delimiters that has the centre in it."""
    found = F.filter(F.regexp_extract_all(s, F.lit(f"(?s){re.escape(left)}(.*?){re.escape(right)}"), F.lit(1)), lambda x: F.contains(x, F.lit(centre)))
    return F.try_element_at(found, F.lit(n))


def word_replace(s: Column, old: str, new: str, option: str = "+*") -> Column:
    """+* all, +n the n-th from the front, -n from the back; + or - alone: the first from there."""
    if option.endswith("*"):
        return F.replace(s, F.lit(old), F.lit(new))
    n = int(option[1:] or 1)
    if option[0] == "+":
        left = F.substring_index(s, old, n)
        there = F.size(F.split(s, re.escape(old), -1)) > n
        return F.when(there, F.concat(left, F.lit(new), F.substring(s, F.length(left) + len(old) + 1, F.length(s)))).otherwise(s)
    right = F.substring_index(s, old, -n)
    there = F.size(F.split(s, re.escape(old), -1)) > n
    return F.when(there, F.concat(F.substring(s, F.lit(1), F.length(s) - F.length(right) - len(old)), F.lit(new), right)).otherwise(s)


def word_add(s: Column, sep: str, words: str, remove: bool = False) -> Column:
    """Words that are not yet there are appended; or words are taken out."""
    have, more = _parts(s, sep), F.array(*[F.lit(w) for w in words.split(sep) if w])
    return F.array_join(F.array_except(have, more) if remove else F.array_union(have, more), sep)


def word_insert(s: Column, sep: str, word: str, n: int) -> Column:
    """The word at place n of the list; at the end if the list is shorter."""
    parts = _parts(s, sep)
    head = F.slice(parts, F.lit(1), F.lit(n - 1)) if n > 1 else F.array().cast("array<string>")
    return F.array_join(F.concat(head, F.array(F.lit(word)), F.slice(parts, F.lit(n), F.size(parts) + 1)), sep)


def str_filter(s: Column, keep: str = "", drop: str = "", upper: bool | None = None) -> Column:
    """Characters of the class ``keep`` only, without those of ``drop``, in one case if asked."""
    if keep:
        s = F.regexp_replace(s, f"[^{keep}]", "")
    if drop:
        s = F.regexp_replace(s, f"[{drop}]", "")
    return s if upper is None else F.upper(s) if upper else F.lower(s)


def version_compare(a: Column, b: Column) -> Column:
    """0 equal, 1 the first is newer, 2 the second; missing parts count as 0."""
    parts = lambda v: F.transform(F.split(v, r"\."), lambda x: F.coalesce(x.try_cast("long"), F.lit(0).cast("long")))
    n = F.greatest(F.size(parts(a)), F.size(parts(b)))
    pad = lambda v: F.concat(parts(v), F.array_repeat(F.lit(0).cast("long"), n - F.size(parts(v))))
    return F.when(pad(a) == pad(b), 0).when(pad(a) > pad(b), 1).otherwise(2)


def version_convert(v: Column, alphabet: str = "abcdefghijklmnopqrstuvwxyz") -> Column:
    """Letters behind a version part become a part of their own: their number in the alphabet, two digits."""
    for i, c in enumerate(alphabet, 1):
        v = F.regexp_replace(v, f"(?i){c}", f".{i:02d}")
    return v
