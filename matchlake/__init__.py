"""Match analytics as Spark jobs: vendor tables to forecasts."""
