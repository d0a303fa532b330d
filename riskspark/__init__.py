"""riskspark: credit- and fraud-risk table operators on Spark DataFrames."""

__version__ = "0.1.0"
