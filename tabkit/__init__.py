"""tabkit: Spark-native claims matching, XML mapping and table statistics.

Every public operator takes and returns DataFrames; the heavy work runs as
Spark jobs (scans, joins, grouped aggregates, windows inside partitions).
"""

__version__ = "0.1.0"
