"""Column expressions: time parts, keys, cleaning, web-log and text parsing."""
