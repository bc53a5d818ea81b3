"""Operators by name.

An operator is a function of (sheets, params) that returns new or changed
sheets; sheets are named DataFrames.  A plan is a list of operator names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tarnflow.params import Params

Sheets = dict[str, DataFrame]
_KNOWN: dict[str, Callable[[Sheets, Params], Sheets]] = {}


def operator(name: str, sheet: str = "data", needs: tuple[str, ...] = ()):
    """Registers an operator and checks the columns that it needs."""

    def register(function):
        def checked(sheets: Sheets, params: Params) -> Sheets:
            if sheet not in sheets:
                raise KeyError(f"operator {name}: no sheet {sheet}")
            lacking = [c for c in needs if c not in sheets[sheet].columns]
            if lacking:
                raise KeyError(f"operator {name}: sheet {sheet} lacks {', '.join(lacking)}")
            return {**sheets, **function(sheets, params)}

        _KNOWN[name] = checked
        return function

    return register


def get(name: str) -> Callable[[Sheets, Params], Sheets]:
    if name not in _KNOWN:
        raise KeyError(f"no operator {name}; known: {', '.join(sorted(_KNOWN))}")
    return _KNOWN[name]


def names() -> list[str]:
    return sorted(_KNOWN)


def run(plan: list[str], sheets: Sheets, params: Params = Params()) -> Sheets:
    """Applies operators in turn."""
    for name in plan:
        sheets = get(name)(sheets, params)
    return sheets
