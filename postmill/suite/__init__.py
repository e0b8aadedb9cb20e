"""Queries over the shared tables, each with the SQL it must agree with."""
