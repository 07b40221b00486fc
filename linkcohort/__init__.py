"""Building analysis-ready cohorts from linked administrative data on Spark."""

from linkcohort.config import Compat, Config

__all__ = ["Compat", "Config"]
