"""Website page-view analytics as PySpark DataFrame operators."""
