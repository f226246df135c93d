"""Imports every query module so that the registry is complete."""

from __future__ import annotations

import importlib

MODULES = ["q_scan", "q_post", "q_score", "q_enrich", "q_tree", "q_asr", "q_io"]


def load() -> None:
    for name in MODULES:
        importlib.import_module(f"sitewise.plans.{name}")


load()
