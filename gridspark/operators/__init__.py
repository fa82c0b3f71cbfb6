"""Grid operators: windows, joins and aggregations over the cell table."""
