"""Structured Streaming forms of the usage and de-duplication transforms."""
