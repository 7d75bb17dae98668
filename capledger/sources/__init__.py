"""Readers for landed inputs and stored tables."""
