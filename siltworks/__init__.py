"""siltworks: event-lake loading and corpus preparation as Spark DataFrame jobs."""
