"""Record matching, aggregation and scoring on Spark DataFrames."""
