"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from palimpsest.plans.registry import gather

MODULES = ("text_queries", "size_queries", "garbled_queries", "page_queries")


def extra() -> tuple[dict, dict]:
    return gather("palimpsest.llm", MODULES)
