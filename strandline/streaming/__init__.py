"""Structured Streaming forms: not needed for batch results, for tables that grow by the day."""
