"""Data-quality, privacy, star-schema and reporting operators on Spark DataFrames."""
