"""Literals that every match of a regular expression holds, for joining patterns with texts.

A pattern with groups, classes or alternatives often still needs some plain text: ``(news|blog)\\.example``
needs ``.example``; ``(promo|ads)[0-9]+`` needs ``promo`` or ``ads``. ``required_literals`` finds, per pattern, a
list of literals of which every match holds at least one (one literal when all matches share it). A link that
holds none of them cannot match, so the pattern need only be tried on links that hold one; the pattern itself
decides. Patterns that Python's parser does not read as Java does are left to the scan: those with flags,
Unicode properties, quoting or back references give None.
"""

from __future__ import annotations

import re
from re import _constants as C, _parser as P

import pandas as pd
from pyspark.sql import Column, functions as F

_UNSURE = re.compile(r"\\[pPQEhHvVRXzZG]|\(\?[a-zA-Z]|\(\?<[a-zA-Z]|\\k<|\\[1-9]|&&")
_REPEATS = (C.MAX_REPEAT, C.MIN_REPEAT) + ((C.POSSESSIVE_REPEAT,) if hasattr(C, "POSSESSIVE_REPEAT") else ())


def _need(items) -> list[str] | None:
    """The best requirement of a sequence: the literals of which a match holds one, or None."""
    found: list[list[str]] = []
    run: list[str] = []

    def close():
        if run:
            found.append(["".join(run)])
            run.clear()

    for op, av in items:
        if op is C.LITERAL:
            run.append(chr(av))
            continue
        close()
        if op is C.SUBPATTERN:
            group, add, remove, inner = av
            if add or remove:
                return None
            need = _need(inner.data)
            if need:
                found.append(need)
        elif op in _REPEATS:
            least, _, inner = av
            need = _need(inner.data) if least >= 1 else None
            if need:
                found.append(need)
        elif op is C.BRANCH:
            options = []
            for branch in av[1]:
                need = _need(branch.data)
                if not need:
                    options = None
                    break
                options.extend(need)
            if options:
                found.append(sorted(set(options)))
        elif op in (C.GROUPREF, C.GROUPREF_EXISTS):
            return None
    close()
    if not found:
        return None
    return max(found, key=lambda need: (min(map(len, need)), -len(need)))


def required_literals(pattern: str | None) -> list[str] | None:
    """Literals of which every match of ``pattern`` (a Java regular expression) holds one; None if unknown."""
    if not pattern or _UNSURE.search(pattern):
        return None
    try:
        parsed = P.parse(pattern)
    except (re.error, OverflowError, RecursionError, ValueError):
        return None
    if parsed.state.flags & (re.IGNORECASE | re.VERBOSE):
        return None
    need = _need(parsed.data)
    return need if need and all(need) else None


def literals_of(patterns: Column) -> Column:
    """``required_literals`` of a column of patterns, ``array<string>``, in Arrow batches."""

    @F.pandas_udf("array<string>")
    def found(values: pd.Series) -> pd.Series:
        return values.map(required_literals)

    return found(patterns)
