"""Smart utility-meter analytics as PySpark DataFrame jobs and streams."""
