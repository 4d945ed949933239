"""Column functions: everything here returns native Spark columns, never a Python UDF."""
