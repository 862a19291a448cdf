"""tidemark: point-in-time market analytics as declarative Spark plans."""
