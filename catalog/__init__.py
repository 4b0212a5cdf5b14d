"""Registered queries: each operator over tables derived from the given ones, plus its SQL twin."""

import importlib
import pkgutil


def load() -> None:
    """Import every catalog module, so that its queries register themselves."""
    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")
