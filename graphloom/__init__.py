"""Property-graph analytics on PySpark DataFrames."""
