"""valuemill: a Spark-native engine for tabular feature building, scoring and evaluation.

Raw records are cleaned with Catalyst expressions (``valuemill.functions``), encoded,
imputed and scaled with Spark ML stages (``valuemill.operators``), split and tuned with
``GBTRegressor`` + ``CrossValidator`` (``valuemill.plans``), and scored into a keyed
prediction store in batch or with Structured Streaming (``valuemill.streaming``).
"""

__version__ = "0.1.0"
