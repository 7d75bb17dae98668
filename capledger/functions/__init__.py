"""Column expressions. Nothing in this package triggers a job or needs a Python worker."""
