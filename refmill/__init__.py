"""refmill: governed reference-data ingestion and analytics as Spark jobs."""

ENGINE_VERSION = "1.0.0"
