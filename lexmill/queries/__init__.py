"""Registered queries over the corpus tables, each with the SQL that gives the same rows."""
