"""Amplicon feature-table analytics on Spark: long, typed DataFrames and lazy operators over them."""
