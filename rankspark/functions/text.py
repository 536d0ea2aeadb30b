"""Case-insensitive substring filters (F3) and multi-term search."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, functions as F

# A term is a run of text in which quoted stretches may hold blanks.
_TERM = re.compile(r"""[^\s'"]*(?:(?:"[^"]*"|'[^']*')[^\s'"]*)+|\S+""")


def contains_ci(column: Column, term: str) -> Column:
    """Literal substring test without regard to case; ``%`` and ``_`` are plain text."""
    return F.contains(F.lower(column.cast("string")), F.lower(F.lit(term)))


def search_terms(query: str) -> list[str]:
    """Split a search box entry at blanks; a fully quoted phrase is one term."""
    terms = []
    for term in _TERM.findall(query):
        if len(term) > 1 and term[0] == term[-1] and term[0] in "'\"":
            term = term[1:-1]
        if term:
            terms.append(term)
    return terms


def contains_any(columns: Iterable[Column], term: str) -> Column:
    """The term occurs in at least one column; never NULL."""
    tests = (F.coalesce(contains_ci(c, term), F.lit(False)) for c in columns)
    return reduce(lambda a, b: a | b, tests)
