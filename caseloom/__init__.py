"""Customer-support triage analytics on Spark DataFrames."""
