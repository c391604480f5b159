"""Imports every query module so the registry is complete."""

from __future__ import annotations

from labelflow.plans import (  # noqa: F401
    chat_queries, compare_queries, io_queries, metric_queries, model_queries, text_queries)
from labelflow.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
