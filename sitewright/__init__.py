"""Business-listing analytics on Spark.

Raw listing batches are landed by date, cleaned, located, checked, rolled up
into reporting tables and validated. Every operator takes DataFrames and
returns a DataFrame; the run time is always an argument.
"""
