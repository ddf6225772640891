from .nulls import if_else_na, in_set, not_in_set, try_number
from .samples import sample_expr
from .text import (
    detect,
    extract_first,
    first_token,
    pad_left,
    remove,
    replace_map,
    separate,
    strip_leading_zeros,
    strip_to_last,
    trim_ws,
)

__all__ = [
    "detect",
    "extract_first",
    "first_token",
    "if_else_na",
    "in_set",
    "not_in_set",
    "pad_left",
    "remove",
    "replace_map",
    "sample_expr",
    "separate",
    "strip_leading_zeros",
    "strip_to_last",
    "trim_ws",
    "try_number",
]
