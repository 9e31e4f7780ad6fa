"""tablelab: data-analysis operators that run on Spark DataFrames end to end."""
