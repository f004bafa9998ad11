"""Column helpers: plain expressions, no UDFs."""
