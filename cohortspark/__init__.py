"""cohortspark: multi-cohort feature, stacking and attribution jobs on Spark.

Subpackages: ``sources`` (scans, sinks), ``functions`` (column and schema
helpers), ``operators`` (DataFrame operators), ``plans`` (bindings, jobs and
registered queries), ``streaming`` (micro-batch scoring).
"""

__version__ = "0.1.0"
