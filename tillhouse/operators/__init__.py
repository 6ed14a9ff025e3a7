"""Table-level operators: versions, joins, checks, sampling, running totals."""
