"""terrane: tag rules, entity dataflow and geometry on PySpark DataFrames."""

__version__ = "0.1.0"
