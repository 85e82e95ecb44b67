"""Functions over lines of texts and key=value configurations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lines(df: DataFrame, text: str, id_col: str) -> DataFrame:
    """(id, n, line): lines from 1, without line ends."""
    return df.select(id_col, F.posexplode(F.split(text, r"\r?\n", -1)).alias("n", "line")).withColumn("n", F.col("n") + 1)


def line_read(text: Column, n: int) -> Column:
    """Line n; negative from the end; null beyond."""
    return F.try_element_at(F.split(text, r"\r?\n", -1), F.lit(n))


def line_sum(text: Column) -> Column:
    return F.size(F.split(text, r"\r?\n", -1))


def line_find(df: DataFrame, text: str, id_col: str, first: int, last: int) -> DataFrame:
    """Lines of a range; negative numbers count from the end."""
    numbered = lines(df, text, id_col).withColumn("of", F.max("n").over(Window.partitionBy(id_col)))
    at = lambda k: F.lit(k) if k > 0 else F.col("of") + (k + 1)
    return numbered.where(F.col("n").between(at(first), at(last))).drop("of")


def from_end(df: DataFrame, text: str, id_col: str) -> DataFrame:
    """Lines numbered from the last."""
    numbered = lines(df, text, id_col)
    return numbered.withColumn("n", F.max("n").over(Window.partitionBy(id_col)) - F.col("n") + 1)


def file_join(first: Column, second: Column) -> Column:
    return F.concat_ws("\n", first, second)


def text_compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """Lines (n, line) that are in one of two texts only, or differ."""
    left, right = a.select("n", F.col("line").alias("was")), b.select("n", F.col("line").alias("now"))
    return left.join(right, "n", "full").where(~F.col("was").eqNullSafe(F.col("now")))


def config_read(text: Column, key: str) -> Column:
    """What stands behind the key on the first line that begins with it."""
    found = F.filter(F.split(text, r"\r?\n"), lambda x: F.lower(x).startswith(key.lower()))
    return F.substring(F.get(found, F.lit(0)), F.lit(len(key) + 1), F.lit(1 << 30))


def config_write(text: Column, key: str, value: str) -> Column:
    """The text with the key's line set, or appended."""
    parts = F.split(text, r"\r?\n", -1)
    mine = lambda x: F.lower(x).startswith(key.lower())
    new = F.transform(parts, lambda x: F.when(mine(x), F.lit(key + value)).otherwise(x))
    return F.array_join(F.when(F.exists(parts, mine), new).otherwise(F.array_append(parts, key + value)), "\n")


def file_recode(data: Column, source: str, target: str) -> Column:
    return F.encode(F.decode(data, source), target)


def parent_path(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)[/\\][^/\\]*$", 1)


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def base_name(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"\.[^.]*$", "")


def file_extension(path: Column) -> Column:
    return F.regexp_extract(file_name(path), r"\.([^.]*)$", 1)


def option(arguments: Column, name: str) -> Column:
    """The value behind an option such as /S= up to the next option."""
    return F.nullif(F.trim(F.regexp_extract(arguments, f"(?i)\\Q{name}\\E(.*?)(?= /|$)", 1)), F.lit(""))
