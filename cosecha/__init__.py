"""Analytics of produce prices, crop production and reservoirs, as Spark DataFrame jobs."""
