"""mlframe: clustering and classification jobs written as DataFrame operators.

Every operator takes DataFrames with the column names listed in the README and
returns DataFrames (or a small driver-side model).  Iteration happens in the
Python driver; the data never leaves Spark.
"""
