"""Trade-account analytics as Spark DataFrame transformations."""
