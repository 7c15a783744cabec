"""DataFrame operators: joins, aggregates, group filters, windows, sorting,
unions, apportionment and statistics.  Every operator takes column names as
arguments, so it runs on the election feeds and on any star-schema table."""

from . import aggregates, apportion, groups, joins, sorting, stats, unions, windows  # noqa: F401
