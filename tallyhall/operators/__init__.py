"""DataFrame -> DataFrame operators (filters, joins, rollups, pivots, explorer)."""
