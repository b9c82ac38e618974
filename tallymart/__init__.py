"""Retail analytics on Spark DataFrames: quality checks, cleaning, a star schema, reports and cubes."""
