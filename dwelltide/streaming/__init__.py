"""Stateful streams, sinks and metrics."""
