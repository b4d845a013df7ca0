"""Column expressions: time, names and values. Built-in Spark functions only."""
