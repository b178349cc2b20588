"""Column expressions; all run inside the JVM."""
