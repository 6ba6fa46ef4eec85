"""cadence: sequence analytics and next-item recommendation on Spark.

Every operator is a DataFrame -> DataFrame function built from Spark SQL
expressions, joins, aggregates and windows, so Catalyst plans it and the
work is partitioned and shuffled by Spark.
"""

__version__ = "0.1.0"
