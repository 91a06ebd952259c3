"""Pull, describe and load tables with Spark DataFrames."""

from tablepull.spec import SpecError, TableSpec

__all__ = ["SpecError", "TableSpec"]
