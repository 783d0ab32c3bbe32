"""Sales integration and star-schema analytics as Spark DataFrame operators."""
