"""Column -> Column expressions.  Nothing here shuffles or leaves the JVM."""
