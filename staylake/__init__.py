"""Stay, weather and clickstream analytics as PySpark DataFrame jobs."""
