"""Weather, air-quality and social-signal analytics as PySpark DataFrame operators."""
