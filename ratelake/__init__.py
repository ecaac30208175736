"""ratelake: Spark-native rate and booking analytics.

Operators take DataFrames and column names and return DataFrames built from
built-in Spark expressions; only ``sources`` and ``plans`` touch storage.
"""

__version__ = "0.1.0"
