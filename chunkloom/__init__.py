"""chunkloom: keep searchable content tables in step with changing file collections, on Spark."""

from chunkloom.plans.flow import Flow, build_flow

__all__ = ["Flow", "build_flow"]
