"""DataFrame -> DataFrame operators (filters, renames, joins, windows, text,
indicators, composite index)."""
