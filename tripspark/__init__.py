"""Trip-fare pipeline on Spark: ingest, batching, features, training, scoring."""

__version__ = "0.1.0"
