"""Column expressions over built-in functions; nothing here leaves the JVM."""
