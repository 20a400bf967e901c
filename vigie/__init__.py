"""vigie — failure-risk analytics on a monthly firm panel, written for Spark.

Every operator is a function ``DataFrame -> DataFrame`` (or a small driver-side
result computed by one distributed aggregation), so that a whole model run is
a handful of Catalyst plans.  Sub-packages:

* ``sources``   — the feature panel, CSV/JSON/parquet readers and writers.
* ``operators`` — scan/sample, cleaning, splits, metrics, thresholds,
  explanations, model merge, expert adjustment, synthetic firms, model fit.
* ``functions`` — column expressions (feature recipes, flags, hashes).
* ``plans``     — pipelines of steps, model specifications, the model run.
"""

__version__ = "0.1.0"
