"""Column expressions and text parsing; see README.md."""
