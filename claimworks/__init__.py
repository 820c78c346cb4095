"""Claims analytics on Spark: strict ingest, quality gate, idempotent publish, standing analyses."""

__version__ = "0.1.0"
