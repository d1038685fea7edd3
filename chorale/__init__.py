"""Short-text and message analytics as plain Spark DataFrame operators."""
