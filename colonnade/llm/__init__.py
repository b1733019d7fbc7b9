"""Operators of a training-data pipeline: cleaning, near-duplicates, classifiers, tokens, shards."""

import importlib
import pkgutil

from colonnade.llm.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "load_all"]


def load_all() -> None:
    """Import every module, which registers its query."""
    for module in sorted(m.name for m in pkgutil.iter_modules(__path__)):
        importlib.import_module(f"{__name__}.{module}")
