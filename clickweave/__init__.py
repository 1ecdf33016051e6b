"""Click-modelling data work as Spark DataFrame jobs."""
