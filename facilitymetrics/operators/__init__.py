"""Reusable DataFrame operators: selection, joins, grouping, ordering and reshaping."""
