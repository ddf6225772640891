"""Text helpers. Every one is a built-in JVM expression; there is no Python UDF."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = r"[\s\p{Z}]+"
NON_ALNUM = r"[^\p{Alnum}]+"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def replace_map(c: str | Column, rules: Mapping[str, str]) -> Column:
    """Apply ``pattern -> replacement`` one after the other, each on the previous result."""
    out = _col(c)
    for pattern, replacement in rules.items():
        out = F.regexp_replace(out, pattern, replacement)
    return out


def remove(c: str | Column, pattern: str) -> Column:
    return F.regexp_replace(_col(c), pattern, "")


def extract_first(c: str | Column, pattern: str) -> Column:
    """First match, NULL when there is none (look-around allowed)."""
    return F.regexp_substr(_col(c), F.lit(pattern))


def detect(c: str | Column, pattern: str, ignore_case: bool = False) -> Column:
    return _col(c).rlike(("(?i)" if ignore_case else "") + pattern)


def strip_to_last(c: str | Column, sep: str = "_") -> Column:
    """What follows the last ``sep``; the whole text when there is none."""
    return F.substring_index(_col(c), sep, -1)


def first_token(c: str | Column, pattern: str) -> Column:
    return F.get(F.split(_col(c), pattern), F.lit(0))


def strip_leading_zeros(c: str | Column) -> Column:
    return F.regexp_replace(_col(c), "^0+", "")


def trim_ws(c: str | Column) -> Column:
    """Both ends, every kind of white space (``trim`` alone only knows the space)."""
    return F.regexp_replace(_col(c), f"^{BLANKS}|{BLANKS}$", "")


def pad_left(c: str | Column, width: int, fill: str = "0") -> Column:
    """Left pad that never shortens a longer text."""
    c = _col(c)
    return F.when(F.length(c) < width, F.lpad(c, width, fill)).otherwise(c)


def separate(
    df: DataFrame,
    c: str,
    into: Sequence[str],
    sep: str = NON_ALNUM,
    extra: str = "drop",
    keep: bool = False,
) -> DataFrame:
    """Split one column into several; short rows fill with NULL.

    ``extra="drop"`` forgets surplus pieces, ``extra="merge"`` leaves them in the last column.
    """
    if extra not in ("drop", "merge"):
        raise ValueError(f"extra must be 'drop' or 'merge', not {extra!r}")
    limit = len(into) if extra == "merge" else -1
    pieces = F.split(F.col(c), sep, limit)
    made = [F.get(pieces, F.lit(i)).alias(name) for i, name in enumerate(into)]
    out = []
    for name in df.columns:
        if name == c:
            out.extend([F.col(c)] if keep and c not in into else [])
            out.extend(made)
        elif name not in into:
            out.append(F.col(name))
    return df.select(*out)
