"""The dataset-building jobs, as compositions of the operators."""

from matchlake.plans.jobs import JOBS, run_job

__all__ = ["JOBS", "run_job"]
