"""Stream and table sources."""
