"""Predicates and conditionals with the NULL rules the count tables depend on."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_set(c: str | Column, values: Iterable) -> Column:
    """Membership that is never NULL; a None in ``values`` matches NULL."""
    c, values = _col(c), list(values)
    known = [v for v in values if v is not None]
    hit = c.isin(known)
    return (c.isNull() | hit) if None in values else (c.isNotNull() & hit)


def not_in_set(c: str | Column, values: Iterable) -> Column:
    """Negated membership: NULL rows are kept unless ``values`` has a None.

    Spelled without ``coalesce`` so that the predicate still reaches the scan.
    """
    c, values = _col(c), list(values)
    known = [v for v in values if v is not None]
    miss = ~c.isin(known)
    return (c.isNotNull() & miss) if None in values else (c.isNull() | miss)


def if_else_na(condition: Column, yes, no) -> Column:
    """Two-way choice where an unknown condition gives NULL, not ``no``."""
    return F.when(condition, yes).when(~condition, no)


def try_number(c: str | Column, kind: str = "bigint") -> Column:
    """Number or NULL; never an error. Text such as ``80300910.0`` counts as a whole number."""
    c = _col(c)
    if kind == "bigint":
        plain = c.try_cast("bigint")
        as_double = c.try_cast("double")
        whole = F.when(as_double == F.floor(as_double), as_double.try_cast("bigint"))
        return F.coalesce(plain, whole)
    return c.try_cast(kind)
