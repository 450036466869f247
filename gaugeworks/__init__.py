"""Asset-record reconciliation and training-data operators on PySpark DataFrames."""
