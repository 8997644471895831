"""Data models and the run that builds and checks them."""

from tierkit.plans.build import build_models, run_daily

__all__ = ["build_models", "run_daily"]
