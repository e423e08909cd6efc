"""affinity: recommendation features from shop logs, on Spark.

Daily user-product events, correlated cross-occurrence by log-likelihood
ratio, popularity / trend / acceleration scores, in-category text
similarity, and the serving table that joins them -- all as DataFrame /
Spark SQL / pyspark.ml plans.
"""

__version__ = "0.1.0"
