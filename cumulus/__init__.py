"""cumulus: analytics over periodic snapshots of cumulative counts, on Spark.

Every public operator takes DataFrames (plus plain parameters) and returns a
lazy DataFrame or Column; Spark plans and runs all of the work.
"""

__version__ = "0.1.0"
