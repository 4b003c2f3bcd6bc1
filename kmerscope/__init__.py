"""kmerscope: k-mer similarity analytics on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark's own
expressions, joins, aggregates and windows; k-mer counting and the screening of
set pairs inside a task run on numpy arrays.
"""

__version__ = "0.1.0"
