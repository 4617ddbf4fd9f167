"""Validation run: slug coverage and job counts against another source."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.operators import coverage, sampling
from hirelake.plans.discovery import AGGREGATOR_SOURCE, INDEX_SOURCE
from hirelake.sources.boards import REGISTRY


@dataclass(frozen=True)
class ValidationResult:
    coverage: DataFrame
    coverage_totals: DataFrame
    comparison: DataFrame
    summary: DataFrame


def validate_coverage(snapshot: DataFrame, names: Iterable[str] | None = None,
                      labels: tuple[str, str] = (INDEX_SOURCE, AGGREGATOR_SOURCE)) -> DataFrame:
    """Coverage report of two sources of a snapshot table."""
    a, b = (snapshot.where(F.col("source") == s) for s in labels)
    return coverage.coverage(a, b, REGISTRY if names is None else names, labels)


def validate_job_counts(jobs: DataFrame, external: DataFrame, sample_size: int = 50,
                        seed: int = 0) -> DataFrame:
    """Sampled companies' job counts compared with the external ones."""
    sample = sampling.head_tail_sample(coverage.jobs_per_company(jobs), sample_size, seed)
    return coverage.compare_counts(sample, external)


def validate(snapshot: DataFrame, jobs: DataFrame, external: DataFrame,
             sample_size: int = 50, seed: int = 0) -> ValidationResult:
    report = validate_coverage(snapshot)
    comparison = validate_job_counts(jobs, external, sample_size, seed)
    return ValidationResult(report, coverage.coverage_totals(report), comparison,
                            coverage.comparison_summary(comparison))
