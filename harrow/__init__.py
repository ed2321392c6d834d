"""Market time series and the documents that move them, as composable DataFrame transformations on Spark."""
