"""Service-request analytics on Spark: DataFrame operators and the bronze, silver and gold plans made of them."""
