"""Every query of the library under its public name, with reference SQL where SQL can say it."""

from __future__ import annotations

from supplylens.registry import base
from supplylens.registry import actions, blocks, calls, facts, kpi, stream, text  # noqa: F401  (they register on import)


def queries():
    return dict(base.QUERIES)


def sql():
    return dict(base.SQL)
