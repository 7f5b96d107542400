"""Column functions: text, time, markup and log-line expressions."""
