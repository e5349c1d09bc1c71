"""strata: layered (bronze / silver / gold) product-data processing on Spark.

Operators are DataFrame -> DataFrame functions over built-in Spark SQL
expressions, joins, windows and aggregates. ``strata.plans`` composes them into
layers that publish versioned Parquet tables.
"""

__version__ = "0.1.0"
