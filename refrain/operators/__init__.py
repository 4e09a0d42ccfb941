"""DataFrame operators: filters, projections, joins, ranking, quality."""
