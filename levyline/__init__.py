"""Filing analytics on Spark: batch and streaming operators over tax-filing events."""
