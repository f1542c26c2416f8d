"""Column expressions: ``Column -> Column``, all JVM-side."""
