"""clickroll: session-value analytics expressed as Spark DataFrame plans.

Sub-packages
------------
sources     event adapters, CSV / parquet readers and writers, templates
functions   column expressions (ratios, entropy, target transforms) and schema helpers
operators   session features, labels, last items, folds, encodings, profiles, predictions
plans       end-to-end jobs (feature build, baseline, boosted trees) and the query catalogue
streaming   incremental refresh of session features from a file stream
"""

__version__ = "0.1.0"
