"""Column expressions. Everything here builds a Column and stays inside the JVM."""
