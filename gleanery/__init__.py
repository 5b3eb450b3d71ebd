"""Spark-first curation and evaluation engine: nested sources, name reconciliation, capped selection,
duplicate clustering, leakage-free splits, scoring and quality gates over DataFrames."""

__version__ = "0.1.0"
