"""vela: whole-table analysis and model evaluation on Spark.

Every operator takes DataFrames and returns DataFrames (or a small fitted
model object whose ``transform`` is a column expression).  The heavy work is
Spark aggregation, joins and ``pyspark.ml`` fits; only results of bounded
size (d x d matrices, per-class moments, bucket histograms) reach the driver.
"""

__version__ = "0.1.0"
