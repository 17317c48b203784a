"""Point-in-time analytics on Spark: pure DataFrame -> DataFrame operators and the queries built from them."""
