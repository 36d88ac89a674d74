"""Column expressions; all but the per-text character statistics run inside the JVM."""
