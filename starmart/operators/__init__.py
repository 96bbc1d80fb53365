"""Generic table operators: keys, joins, data-quality checks, profiling, report metrics."""
