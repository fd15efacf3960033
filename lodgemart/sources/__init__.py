"""Readers, writers and ingestion."""
