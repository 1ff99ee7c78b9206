"""Burnt-area jobs on Spark: hot spots, scenes, pixels, fire records, publication and audit."""
