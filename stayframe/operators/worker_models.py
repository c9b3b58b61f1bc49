"""Models held by Python workers.

This module is imported by the workers (functions that Spark ships by value
start with empty globals in every task), so a model built here lives as long
as its worker and is shared by all tasks that run in it.
"""

from __future__ import annotations

_MODELS: dict = {}


def model(key: str, factory):
    """The worker's model of a key, built by ``factory()`` the first time."""
    if key not in _MODELS:
        _MODELS[key] = factory()
    return _MODELS[key]
