"""Every query of the library over the benchmark tables, each with an equivalent in ANSI SQL."""
