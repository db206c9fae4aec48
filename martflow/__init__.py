"""martflow: a retail star-schema warehouse on Spark.

Transactions are enriched with customer and product master data, staged,
loaded insert-only into a star schema and queried by star-join
aggregations.  Everything is expressed with DataFrame / Spark SQL /
Structured Streaming built-ins.
"""

__version__ = "0.1.0"
