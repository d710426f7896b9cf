"""Data-quality and incremental-load operators."""
