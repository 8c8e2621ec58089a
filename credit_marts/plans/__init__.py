"""What is run on the credit tables: profiles, layer jobs and the whole pipeline."""

from credit_marts.plans.jobs import BronzeJob, GoldJob, LayerJob, SilverJob, ingest_all
from credit_marts.plans.pipeline import gold_tables, quality_report, run_pipeline, silver_tables
from credit_marts.plans.profiles import (
    LINKS,
    TableProfile,
    profile_queries,
    profile_query,
    profiles,
    run_all,
    table_questions,
)

__all__ = [
    "LINKS",
    "BronzeJob",
    "GoldJob",
    "LayerJob",
    "SilverJob",
    "TableProfile",
    "gold_tables",
    "ingest_all",
    "profile_queries",
    "profile_query",
    "profiles",
    "quality_report",
    "run_all",
    "run_pipeline",
    "silver_tables",
    "table_questions",
]
