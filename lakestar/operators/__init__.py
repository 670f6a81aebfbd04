"""DataFrame operators: skew-safe joins and windows, upserts, profiling, quality."""
