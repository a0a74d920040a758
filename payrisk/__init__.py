"""payrisk: payment-risk features, point-in-time joins, scoring and evaluation on Spark.

Every public function takes and returns Spark DataFrames; the heavy lifting is
done by Catalyst/Tungsten (built-in expressions, aggregates, windows, joins)
and by Structured Streaming for the stream jobs.
"""

__version__ = "0.1.0"
