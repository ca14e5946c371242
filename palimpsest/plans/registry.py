"""All queries and their SQL, gathered from the plan modules of the core."""

from __future__ import annotations

from importlib import import_module

MODULES = ("change_queries", "catalog_queries", "text_queries", "answer_queries")


def gather(package: str, modules: tuple[str, ...]) -> tuple[dict, dict]:
    queries, oracles = {}, {}
    for m in modules:
        mod = import_module(f"{package}.{m}")
        queries.update(mod.QUERIES)
        oracles.update(mod.ORACLES)
    return queries, oracles


def core() -> tuple[dict, dict]:
    return gather("palimpsest.plans", MODULES)
