"""dimflow: Spark-native dimension extract / publish / load toolkit.

Every operator is a function from DataFrames to a DataFrame built from Spark's
own expressions, joins, aggregates and writers.
"""

__version__ = "0.1.0"
