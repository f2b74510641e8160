"""qaforge: passage retrieval and extractive-QA evaluation as Spark DataFrame jobs.

Every operator is a DataFrame -> DataFrame function built from Spark SQL
expressions, joins, aggregations and windows; see README.md for the map.
"""

__version__ = "0.1.0"
