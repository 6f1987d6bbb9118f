"""headway: transit-reliability analytics on Spark DataFrames."""
