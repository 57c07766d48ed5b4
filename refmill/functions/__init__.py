"""Column expressions: JVM-side, no Python in the row path."""
