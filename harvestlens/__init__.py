"""Market-price analytics as Spark DataFrame operators."""
