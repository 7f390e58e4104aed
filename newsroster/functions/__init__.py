"""Column expressions shared by the operators. All are JVM-side."""
