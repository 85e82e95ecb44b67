"""Folds whose result depends on an order: tag maps built from rows, and back, and the first value of a group.

A fold is two aggregations, each of which combines before it shuffles: the last row of each (entity, key), which is a maximum
by order, and then the map of an entity, which holds as many entries as it has keys. So an entity with very many rows is no hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold_tags(rows: DataFrame, by: Sequence[str], key: str, value: str, order: Sequence[str]) -> DataFrame:
    """by and tags: the map of each entity, where of one key the last row in the order counts, with a null value too; keys ascend.

    Rows without a key add nothing, but their entity is there; of rows that are equal in the order the greatest value counts, null the least.
    """
    place = F.struct(*order, value)
    last = rows.groupBy(*by, F.col(key).alias("__key")).agg(F.max_by(F.struct(F.col(value).alias("v")), place).alias("__last"))
    entry = F.when(F.col("__key").isNotNull(), F.struct(F.col("__key").alias("key"), F.col("__last.v").alias("value")))
    return last.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("tags"))


def unfold_tags(entities: DataFrame, by: Sequence[str], tags: str = "tags") -> DataFrame:
    """by, key, value: a row for each tag; entities without tags have none."""
    return entities.select(*by, F.explode(tags))


def first_values(rows: DataFrame, by: Sequence[str], values: Sequence[str], order: Sequence[str]) -> DataFrame:
    """by and, for each of the values, the first in the order that is not null; of equal places the smallest value."""
    firsts = [F.min_by(F.col(v), F.when(F.col(v).isNotNull(), F.struct(*order, v))).alias(v) for v in values]
    return rows.groupBy(*by).agg(*firsts)
