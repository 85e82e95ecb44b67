"""Numbers: unsigned comparison, formats, splitting of doubles, and a registry of functions by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Functions of one number by name.
UNARY: dict[str, Callable[[Column], Column]] = {
    "sin": F.sin, "cos": F.cos, "tan": F.tan, "asin": F.asin, "acos": F.acos, "atan": F.atan, "sinh": F.sinh, "cosh": F.cosh, "tanh": F.tanh,
    "exp": F.exp, "ln": F.log, "log10": F.log10, "sqrt": F.sqrt, "abs": F.abs, "floor": F.floor, "ceil": F.ceil,
}
BINARY: dict[str, Callable[[Column, Column], Column]] = {"atan2": F.atan2, "pow": F.pow, "fmod": lambda a, b: a % b}


def unsigned(c: Column, bits: int = 64) -> Column:
    """A signed number's bits read as unsigned."""
    wide = c.cast("decimal(20,0)")
    return F.when(c < 0, wide + F.lit(str(2**bits)).cast("decimal(20,0)")).otherwise(wide)


def unsigned_less(a: Column, b: Column, bits: int = 64) -> Column:
    return unsigned(a, bits) < unsigned(b, bits)


def frexp(x: Column) -> tuple[Column, Column]:
    """Mantissa in [0.5, 1) and exponent."""
    e = F.when(x == 0, 0).otherwise(F.floor(F.log2(F.abs(x))) + 1)
    return F.when(x == 0, F.lit(0.0)).otherwise(x / F.pow(F.lit(2.0), e)), e.cast("int")


def modf(x: Column) -> tuple[Column, Column]:
    """Fraction and whole part, both with the sign of x."""
    whole = F.when(x < 0, F.ceil(x)).otherwise(F.floor(x)).cast("double")
    return x - whole, whole


def fixed(x: Column, digits: int) -> Column:
    return F.format_number(x, digits)


class Registry:
    """Named tasks from DataFrame to DataFrame; a pipeline is a list of names and arguments."""

    def __init__(self) -> None:
        self.tasks: dict[str, Callable[..., DataFrame]] = {}

    def register(self, name: str, task: Callable[..., DataFrame]) -> None:
        if name in self.tasks:
            raise ValueError(f"task {name!r} is registered already")
        self.tasks[name] = task

    def run(self, df: DataFrame, steps: list[tuple[str, dict]]) -> DataFrame:
        for name, arguments in steps:
            if name not in self.tasks:
                raise KeyError(f"no task {name!r}; there are {sorted(self.tasks)}")
            df = self.tasks[name](df, **arguments)
        return df
