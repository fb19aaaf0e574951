"""sparkwork: text statistics and model fitting as plain functions over Spark DataFrames."""

__version__ = "0.1.0"
