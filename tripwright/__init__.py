"""Trip analytics on Spark: monthly trip files to raw, staging and mart tables."""
