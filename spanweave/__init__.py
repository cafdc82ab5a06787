"""spanweave: interval, profile and plan analytics on PySpark DataFrames."""
