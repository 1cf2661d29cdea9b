"""Named queries: a Spark plan and the independent SQL that checks it."""

import importlib

from riskloom.plans.registry import ORACLES, QUERIES

FAMILIES = [
    "features", "bands", "joins", "portfolio", "ranking", "privacy", "scoring", "explain", "load", "audit", "evaluation", "survey",
]

for _family in FAMILIES:
    importlib.import_module(f"riskloom.plans.{_family}")

__all__ = ["ORACLES", "QUERIES"]
