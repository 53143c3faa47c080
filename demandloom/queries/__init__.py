"""Queries over the library's jobs, each next to the SQL that states the same."""
