"""Reusable DataFrame operators: filters, joins, aggregates, ranking, checks."""
