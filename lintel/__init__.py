"""lintel: corpus curation, text mining and classification evaluation as Spark plans."""
