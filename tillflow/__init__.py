"""tillflow: payment analytics written for Spark DataFrames."""
