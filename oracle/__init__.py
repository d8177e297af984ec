"""DuckDB twins of the registered queries.

Written the plain way - windows over whole partitions, range joins, recursive
closure - so that they check the distributed forms rather than repeat them.
Each query is one self-contained statement over the driver's tables.
"""

from __future__ import annotations

import re

from oracle.models import MODELS
from oracle.queries import QUERIES


def _needed(text: str) -> set[str]:
    return {name for name in MODELS if re.search(rf"\b{name}\b", text)}


def statement(select: str) -> str:
    """`select` with the models it mentions, directly or not, as CTEs in order."""
    todo, used = [select], set()
    while todo:
        for name in _needed(todo.pop()) - used:
            used.add(name)
            todo.append(MODELS[name])
    ctes = ",\n".join(
        f"{n} AS MATERIALIZED ({MODELS[n].strip()})" if not n.startswith("reach")
        else f"{n} AS ({MODELS[n].strip()})"
        for n in MODELS
        if n in used
    )
    return f"WITH RECURSIVE {ctes}\n{select.strip()}" if ctes else select.strip()


def oracle_queries() -> dict[str, str]:
    return {name: statement(text) for name, text in QUERIES.items()}
