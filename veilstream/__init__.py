"""veilstream: change-data de-identification, time travel and data repair on Spark DataFrames."""

__version__ = "0.1.0"
