"""Patient record linkage and receivables analytics as Spark DataFrame jobs."""
