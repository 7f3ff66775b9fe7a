"""Column and frame functions that Spark does not have built in."""
