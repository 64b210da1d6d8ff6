"""Column expressions. Everything here returns Columns and runs inside the JVM."""
