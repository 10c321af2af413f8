"""tripkiln: trip-record refinement (silver cleansing, gold features) on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark's
built-in expressions, so whole pipelines compose with ``DataFrame.transform``
and are optimized by Catalyst as one logical plan.
"""

__version__ = "0.1.0"
