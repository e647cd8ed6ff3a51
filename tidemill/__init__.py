"""Market-lakehouse analytics on Spark: DataFrame operators, contracts, streams and marts."""
