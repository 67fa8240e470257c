"""Social-graph and news analytics written as Spark DataFrame jobs."""
