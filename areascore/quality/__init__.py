"""Declarative data-quality rules and the ingestion audit log."""
