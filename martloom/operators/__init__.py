"""Dataset-to-dataset operators."""
