"""Column functions, all evaluated inside Spark plans."""
