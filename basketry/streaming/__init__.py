"""Structured Streaming wiring, replay-safe writers and the job entry point."""
