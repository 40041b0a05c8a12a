"""cuelake: timed-text analytics on PySpark DataFrames."""
