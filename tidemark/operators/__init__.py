"""DataFrame operators: staging, versions, joins, schema work, marks, quality."""
