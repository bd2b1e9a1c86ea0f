"""Content analytics on Spark: launch funnels, audience shares, forecasts."""
