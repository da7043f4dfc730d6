"""Registered report jobs (one per operator key) and their oracle SQL."""

from __future__ import annotations


def all_jobs():
    from . import jobs_checks, jobs_core, jobs_fx, jobs_planning, jobs_profit, jobs_statements, jobs_time, jobs_variance  # noqa: F401  (registers on import)
    from .registry import JOBS

    return dict(JOBS)
