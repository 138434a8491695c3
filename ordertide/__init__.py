"""Order analytics on Spark: demand, trends, fulfillment and data quality.

Every operator is a function from DataFrames to a DataFrame, written with
Spark's own expressions, so a caller can chain them with ``DataFrame.transform``.
"""

__version__ = "0.1.0"
