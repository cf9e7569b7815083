"""Independent DuckDB SQL for every registered query (the correctness gate).

The SQL is written in the naive shape (join first, then aggregate; ``NOT
IN`` subqueries; windows over the joined rows) so that it checks the
rewritten Spark plans rather than repeating them.
"""
