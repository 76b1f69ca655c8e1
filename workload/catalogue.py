"""All queries and checks by name."""

from __future__ import annotations

import importlib

GROUPS = ("imaging", "staining", "sequencing", "vectors", "objects", "files")


def _groups():
    return [importlib.import_module(f"workload.{name}") for name in GROUPS]


def queries() -> dict:
    return {name: fn for group in _groups() for name, fn in group.QUERIES.items()}


def checks() -> dict:
    return {name: text for group in _groups() for name, text in group.CHECKS.items()}
