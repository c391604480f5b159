"""labelflow: text-classification data preparation and evaluation on Spark DataFrames."""

__version__ = "0.1.0"
