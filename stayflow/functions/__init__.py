"""Column expressions for dirty clinical text; all of them built-in functions."""
