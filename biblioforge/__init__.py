"""A Spark-first engine for bibliographic integration."""
