"""Registered queries over the test tables, each with its SQL for cross-checking."""
