"""Market price analytics as Spark DataFrame plans."""
