"""Column expressions: each takes and returns Columns and stays inside the JVM."""
