"""Customer-churn analytics on Spark: profiling, preparation, selection, training, scoring, upkeep."""
