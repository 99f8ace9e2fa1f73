"""Time-series archive operators for Spark: DataFrames in, DataFrames out."""
