"""Real-time commerce metrics on Spark: DataFrames in, DataFrames out."""
