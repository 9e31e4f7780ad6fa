"""All registered queries and their SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = ["q_relational", "q_basket", "q_recommend", "q_text", "q_space", "q_models", "q_io"]


def collect(attribute: str) -> dict:
    out: dict = {}
    for name in MODULES:
        out.update(getattr(import_module(f"{__package__}.{name}"), attribute))
    return out
