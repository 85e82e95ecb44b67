"""Translations of labels and of symbol objects."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def check_language(code: str) -> str:
    if not re.fullmatch("[A-Za-z]{2}", code):
        raise ValueError(f"a language code has two letters: {code!r}")
    return code.upper()


def add_language(rows: DataFrame, new: str, old: str) -> DataFrame:
    """Rows (key, lang, text, ...) with a copy of each row of ``old`` for ``new``."""
    new, old = check_language(new), check_language(old)
    if new == old:
        raise ValueError("a language cannot be copied from itself")
    return rows.unionByName(rows.where(F.col("lang") == old).withColumn("lang", F.lit(new)))


def remove_language(rows: DataFrame, code: str) -> DataFrame:
    return rows.where(~F.col("lang").eqNullSafe(check_language(code)))


def change_languages(rows: DataFrame, add: str | None = None, copy: str | None = None, remove: str | None = None) -> DataFrame:
    """Exactly one of: add with copy, or remove."""
    if (add is None) == (remove is None) or (add is None) != (copy is None):
        raise ValueError("give either add and copy, or remove")
    return add_language(rows, add, copy) if add else remove_language(rows, remove)


def resolve(rows: DataFrame, lang: str, order: str = "ord") -> DataFrame:
    """(key, text): the requested language, else the default (null) one; of repeated keys the last."""
    mine = rows.where(F.col("lang").isNull() | (F.col("lang") == check_language(lang)))
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.col("lang").isNull(), F.desc(order)))
    return mine.withColumn("r", rank).where("r = 1").select("key", "text")


def add_symbol_language(strings: Column, new: str, old: str) -> Column:
    """A map code -> text with ``new`` set to what ``old`` says, sorted by code."""
    copied = F.map_concat(F.map_filter(strings, lambda k, v: k != new), F.create_map(F.lit(new), F.element_at(strings, F.lit(old))))
    return F.when(F.map_contains_key(strings, old), F.map_from_entries(F.array_sort(F.map_entries(copied)))).otherwise(strings)


def remove_symbol_language(strings: Column, code: str) -> Column:
    return F.map_filter(strings, lambda k, v: k != code)


def symbol_text(strings: Column, code: str) -> Column:
    """The language, else the neutral 0x00, else the first by code."""
    first = F.get(F.array_sort(F.map_entries(strings)), F.lit(0))["value"]
    return F.coalesce(F.element_at(strings, F.lit(code)), F.element_at(strings, F.lit("0x00")), first)


def attach_strings(objects: DataFrame, strings: DataFrame) -> DataFrame:
    """Symbol objects with a map of their strings, by kind, type and subtype."""
    maps = strings.groupBy("kind", "type", "subtype").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("code", "text")))).alias("strings"))
    return objects.join(maps, ["kind", "type", "subtype"], "left")


def draw_order(polygons: DataFrame, levels: DataFrame) -> DataFrame:
    """Polygons with their drawing level; one without is not drawn."""
    return polygons.join(levels, "type")
