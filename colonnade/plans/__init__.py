"""Query definitions, grouped by the kind of work."""

import importlib
import pkgutil


def load_all() -> None:
    for module in sorted(m.name for m in pkgutil.iter_modules(__path__)):
        importlib.import_module(f"{__name__}.{module}")
