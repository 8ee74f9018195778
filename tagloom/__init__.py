"""Question-and-answer dump analytics on Spark.

Every operator takes DataFrames and returns a DataFrame; the jobs in
``tagloom.plans`` put them together.
"""
