"""Trip tables to model-ready features, drift checks, scoring and monitoring on Spark."""
