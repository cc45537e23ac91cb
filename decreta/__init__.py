"""decreta: order-registry ingestion and analytics as Spark table jobs."""
