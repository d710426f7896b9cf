"""Catalog-level plans: tables, models, incremental loads."""
