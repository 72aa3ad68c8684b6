"""cdcflow: change-data and stream processing on PySpark DataFrames."""
