"""Rating analytics and ranking on Spark.

Every operator takes and returns DataFrames; nothing here starts a session.
``plans.batch`` is the spark-submit entry point.
"""

__version__ = "0.1.0"
