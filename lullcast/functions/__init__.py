"""Column expressions, all evaluated in the JVM."""
