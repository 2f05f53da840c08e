"""Table operators: columns, joins, shapes, totals and ordered rows."""
