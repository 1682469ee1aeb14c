"""Lodestrand: crawl analytics and data processing on PySpark DataFrames."""
