"""Registered queries, each with its check in SQL where SQL can express it."""
