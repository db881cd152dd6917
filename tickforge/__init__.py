"""tickforge: sensor analytics and predictive maintenance on Spark DataFrames."""
