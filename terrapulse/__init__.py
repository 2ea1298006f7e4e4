"""Ground-motion time-series analytics on Spark: DataFrame-in, DataFrame-out operators."""
