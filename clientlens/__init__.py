"""clientlens: a Spark-native customer-analytics pipeline.

Every public function takes DataFrames and returns DataFrames; planning and
execution are left to Catalyst/AQE. I/O lives only in ``clientlens.sources``
and in the pipeline runner (``clientlens.plans.pipeline``).
"""

__version__ = "0.1.0"
