"""Credit-history analytics as Spark DataFrame operators."""

from credit_marts.plans import BronzeJob, GoldJob, LayerJob, SilverJob, ingest_all, run_pipeline
from credit_marts.sources import TableSpec

__all__ = [
    "BronzeJob",
    "GoldJob",
    "LayerJob",
    "SilverJob",
    "TableSpec",
    "ingest_all",
    "run_pipeline",
]
