"""Session analytics on Spark: per-entity sessions with long gaps, in batch and in streams."""
