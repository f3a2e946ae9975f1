"""Transaction analytics on Spark: cleaning, warehouse merge, indicators and profiling."""
