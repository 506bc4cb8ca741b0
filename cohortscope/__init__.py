"""Building and evaluating per-person scores over large cohorts, on Spark DataFrames."""
