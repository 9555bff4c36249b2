"""Market and feature time series on Spark: ingest, lake, resampling, lagged correlation, reports."""

from lagloom.params import AnalysisParams
from lagloom.plans.jobs import (
    BackfillSource,
    CorrelationRun,
    backfill,
    correlate_stored,
    incremental_ingest,
    lag_correlation,
    load_tables,
    repair_lake,
    run_correlation,
    sample_report,
    save_results,
)
from lagloom.session import use_utc

__all__ = [
    "AnalysisParams",
    "BackfillSource",
    "CorrelationRun",
    "backfill",
    "correlate_stored",
    "incremental_ingest",
    "lag_correlation",
    "load_tables",
    "repair_lake",
    "run_correlation",
    "sample_report",
    "save_results",
    "use_utc",
]
