"""Column-level building blocks; all built-in, JVM-side expressions."""
