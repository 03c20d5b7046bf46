"""Column -> Column building blocks. Everything but the LCS scorer stays in the JVM."""
