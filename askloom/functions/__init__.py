"""Column-to-column functions; all of them are JVM-side expressions."""
