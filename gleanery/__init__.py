"""Spark-native curation of large tables of binary records.

The package scans raw Parquet tables of ids and payloads, asks a model supplied
by the caller for a keep/reject verdict and then for structured labels, and
writes numbered shards.  Every operator takes and returns DataFrames.
"""

from gleanery.config import CurationConfig, Prompts
from gleanery.plans.jobs import run_filter, run_label, run_stages
from gleanery.streaming.incremental import run_incremental

__all__ = [
    "CurationConfig",
    "Prompts",
    "run_filter",
    "run_incremental",
    "run_label",
    "run_stages",
]
