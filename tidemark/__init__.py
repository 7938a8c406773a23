"""Customer-campaign analytics as parameterised PySpark operators."""
