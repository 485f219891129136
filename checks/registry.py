"""All registered queries and the SQL each is compared with."""

from __future__ import annotations

import importlib

MODULES = (
    "feature_checks", "window_checks", "target_checks", "gain_checks", "score_checks", "drift_checks",
    "sample_checks", "table_checks", "model_checks", "recipe_checks",
)

QUERIES: dict = {}
ORACLES: dict = {}


def _load() -> None:
    for name in MODULES:
        module = importlib.import_module(f"checks.{name}")
        for query, (build, text) in module.CHECKS.items():
            if query in QUERIES:
                raise ValueError(f"query {query} registered twice")
            QUERIES[query] = build
            if text is not None:
                ORACLES[query] = text


_load()
