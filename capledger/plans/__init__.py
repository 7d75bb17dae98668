"""Whole stages: transforms wired together, and the sinks they end in."""
