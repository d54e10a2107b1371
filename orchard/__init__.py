"""orchard: a Spark-native model lifecycle on tables.

Train / evaluate / compare / promote / score, expressed with the DataFrame API
and ``pyspark.ml``.  Sub-packages:

* ``orchard.sources``   – scans, derived views, sinks, model loading
* ``orchard.functions`` – column expressions (features, hashing, statistics)
* ``orchard.operators`` – DataFrame -> DataFrame operators (split, profile,
  metrics, bootstrap, A/B statistics, registry, training, scoring)
* ``orchard.plans``     – end-to-end batch jobs built from the operators
* ``orchard.streaming`` – incremental scoring with Structured Streaming
"""

__version__ = "0.1.0"
