"""All registered plans (importing the plan modules fills the registry)."""

from __future__ import annotations

from docindex.plans import agg_plans, codec_plans, index_plans, mapping_plans, read_plans, store_plans, write_plans  # noqa: F401
from docindex.plans.registry import REGISTRY


def queries():
    return {name: fn for name, (fn, _sql) in REGISTRY.items()}


def oracle_sql():
    return {name: sql for name, (_fn, sql) in REGISTRY.items() if sql}
