"""All registered queries (importing the modules registers them)."""

from __future__ import annotations

from tarmac.plans import registry

_MODULES = [
    "tarmac.plans.q_cleaning",
    "tarmac.plans.q_profile",
    "tarmac.plans.q_functions",
    "tarmac.plans.q_ml",
    "tarmac.plans.q_io",
    "tarmac.plans.q_text",
]


def _load() -> None:
    import importlib

    for m in _MODULES:
        importlib.import_module(m)


def queries():
    _load()
    return dict(registry.QUERIES)


def oracle_sql():
    _load()
    return dict(registry.ORACLE)
