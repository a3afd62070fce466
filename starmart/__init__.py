"""Star-schema and mart building blocks as declarative PySpark operators."""
