"""headgate: extract, split, type and check tables at scale with Spark DataFrames."""

__version__ = "0.1.0"
