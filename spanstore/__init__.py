"""Evidence-addressable document ingestion on Spark."""
