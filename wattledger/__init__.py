"""Five-minute energy deltas from cumulative meter counters, on Spark DataFrames."""
