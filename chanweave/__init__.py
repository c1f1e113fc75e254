"""Channel-catalogue jobs on Spark: parse, clean, match, classify, select and check playlist data as DataFrames."""
