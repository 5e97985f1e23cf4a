"""Metric operators: one DataFrame function per metric, batch and stream."""
