"""Column and small-table helpers."""
