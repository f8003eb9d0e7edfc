"""Composite jobs: the table chain, warehouse build, analysis, quality gate."""

from liftlens.plans.chain import Tables, build_tables

__all__ = ["Tables", "build_tables"]
