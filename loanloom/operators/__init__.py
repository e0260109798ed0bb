"""DataFrame operators: windows, joins, aggregates, statistics, evaluation, policy."""
