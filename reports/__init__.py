"""Reports over the sample tables: each lays tables out as grids or texts and runs an operator.

A report is a callable ``(spark, sf_dir) -> DataFrame`` and, where SQL can say the same directly on
the tables, that SQL.
"""
