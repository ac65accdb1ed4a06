"""tallystar: monthly indicator feeds as a star schema, built and queried with PySpark DataFrames."""
