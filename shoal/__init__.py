"""shoal: detect coordinated rating attacks in review data with Spark.

Every operator is a DataFrame -> DataFrame function built from Spark SQL,
ML and Structured Streaming primitives; the same functions serve batch
tables and streams.
"""

__version__ = "0.1.0"
