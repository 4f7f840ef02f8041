"""Market-data loading and star-schema reporting as Spark DataFrame jobs."""
