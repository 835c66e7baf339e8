"""Column expressions without state; everything stays inside the JVM."""
