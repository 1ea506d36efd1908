"""tidemark: point-in-time text and price analytics expressed as Spark plans."""
