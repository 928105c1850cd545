"""herdflow: weigh-record ingestion, keep-latest master and band coverage reporting on Spark.

Every operator takes and returns DataFrames (or Columns) with key and column names as
parameters, so the same code runs on weigh data and on any table of the same shape.
"""

__version__ = "0.1.0"
