"""Column expressions: no row-at-a-time Python, everything stays in the JVM."""
