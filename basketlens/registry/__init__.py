"""Registered queries and the SQL of their expected results."""
