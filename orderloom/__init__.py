"""orderloom: raw order-line extracts to a checked star schema, as Spark jobs."""
