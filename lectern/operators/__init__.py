"""Relational operators: rules, joins, sequences, aggregates."""
