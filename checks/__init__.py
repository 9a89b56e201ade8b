"""Queries over the driver tables, each with SQL that must give the same rows."""
