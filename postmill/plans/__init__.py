"""Composite jobs: one plan for all organisations."""
