"""Sample ids from file names. A rule is data: a source column and a list of steps."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text

STEPS: dict[str, Callable[..., Column]] = {
    "replace": text.replace_map,
    "remove": text.remove,
    "trim": text.trim_ws,
    "first_token": text.first_token,
    "after_last": text.strip_to_last,
    "strip_zeros": text.strip_leading_zeros,
    "extract": text.extract_first,
    "pad": text.pad_left,
}


def sample_expr(source: str | Column, steps: Sequence[tuple]) -> Column:
    """``[("replace", {...}), ("trim",)]`` -> one column expression, applied in order."""
    out = F.col(source) if isinstance(source, str) else source
    for name, *args in steps:
        out = STEPS[name](out, *args)
    return out
