"""Streaming runners and idempotent sinks."""
