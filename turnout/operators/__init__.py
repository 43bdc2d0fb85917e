"""DataFrame operators: features, aggregates, joins, windows, reshaping, top-k, picks."""
