"""All named queries. Importing a plan module registers its queries."""

from __future__ import annotations

from tillbook.plans import (cleaning, cleaning_job, integrity, lake_increment, medallion,  # noqa: F401
                            shop_analytics, shop_basics, superstore, task_lines)  # importing registers the queries
from tillbook.plans.registry import QUERIES


def queries():
    return {name: fn for name, (fn, _sql) in QUERIES.items()}


def oracle_sql():
    return {name: sql for name, (_fn, sql) in QUERIES.items() if sql}
