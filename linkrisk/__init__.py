"""linkrisk: URL-risk feature, sampling, training and scoring operators for Spark.

Every operator is a plain function from DataFrames to a DataFrame, so plans are
composed with ``DataFrame.transform`` and optimised as a whole by Spark.
"""

__version__ = "0.1.0"
