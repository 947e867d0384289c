"""Relational operators: columns, filters, joins, dedupe, incremental, resolution."""
