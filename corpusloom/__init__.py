"""Corpus cleaning, vector search, soft clustering and a similarity cache as Spark jobs."""
