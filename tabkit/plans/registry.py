"""Merge the per-area query bindings into one registry."""

from __future__ import annotations

import importlib

AREAS = ["bind_claims", "bind_columns", "bind_describe", "bind_inference", "bind_multivar", "bind_soap", "bind_sources", "bind_charts"]


def _modules():
    return [importlib.import_module(f"tabkit.plans.{a}") for a in AREAS]


def all_queries():
    out = {}
    for m in _modules():
        out.update(m.QUERIES)
    return out


def all_sql():
    out = {}
    for m in _modules():
        out.update(getattr(m, "SQL", {}))
    return out
