"""DataFrame -> DataFrame operators (filters, joins, aggregates, windows,
sets, text matching, data quality, model operations)."""
