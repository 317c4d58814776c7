"""Flight-operations and revenue analytics as Spark DataFrame plans."""
