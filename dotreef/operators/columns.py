"""Column-set operators: names, presence, order."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One naming rule, written once and used on the driver (DataFrame headers) and on
# executors (headers of scanned files, see ``clean_header``).
_UNWANTED = {"snake": "[^a-z0-9]+", "dots": "[^a-z0-9._]+"}
_EDGES = {"snake": "^_+|_+$", "dots": "^[._]+|[._]+$"}
_JOINER = {"snake": "_", "dots": "."}


def clean_names(names: Sequence[str], style: str = "snake") -> list[str]:
    """Lower case, separators folded, blanks numbered ``x, x_1, x_2 ...``, repeats ``_2, _3 ...``."""
    joiner = _JOINER[style]
    seen: dict[str, int] = {}
    out = []
    for raw in names:
        name = re.sub(_UNWANTED[style], joiner, raw.replace("\ufeff", "").lower())
        name = re.sub(_EDGES[style], "", name) or "x"
        n = seen[name] = seen.get(name, 0) + 1
        if n > 1:
            name = f"{name}_{n - 1 if name == 'x' else n}"
        out.append(name)
    return out


def tidy_name(c: Column, style: str = "snake") -> Column:
    """``clean_names`` for one header cell, without the numbering of repeats."""
    low = F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), "\ufeff", ""))
    name = F.regexp_replace(F.regexp_replace(low, _UNWANTED[style], _JOINER[style]), _EDGES[style], "")
    return F.when(name == "", F.lit("x")).otherwise(name)


def clean_header(df: DataFrame, column: str, style: str = "snake") -> DataFrame:
    """``clean_names`` for an array-of-text column: headers need not visit the driver.

    Two projections, so that the numbering looks at finished names instead of redoing them.
    """
    df = df.withColumn(column, F.transform(column, lambda c: tidy_name(c, style)))

    def number(c: Column, i: Column) -> Column:
        before = F.size(F.filter(F.slice(column, F.lit(1), i), lambda e: e == c))
        shown = F.when(c == "x", before).otherwise(before + 1)
        return F.when(before == 0, c).otherwise(F.concat_ws("_", c, shown.cast("string")))

    return df.withColumn(column, F.transform(column, number))


def with_clean_names(df: DataFrame, style: str = "snake") -> DataFrame:
    return df.toDF(*clean_names(df.columns, style))


def prefixed(df: DataFrame, *prefixes: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefixes)]


def select_prefix(df: DataFrame, *prefixes: str, also: Iterable[str] = ()) -> DataFrame:
    return df.select(*also, *[c for c in prefixed(df, *prefixes) if c not in set(also)])


def drop_prefix(df: DataFrame, *prefixes: str) -> DataFrame:
    return df.drop(*prefixed(df, *prefixes))


def front(df: DataFrame, *names: str) -> DataFrame:
    """Named columns first, the rest after in their order."""
    return df.select(*names, *[c for c in df.columns if c not in names])


def ensure_cols(df: DataFrame, names: Iterable[str], kind: T.DataType | str = "string") -> DataFrame:
    have = df.columns
    kind = kind if isinstance(kind, str) else kind.simpleString()
    missing = [f"CAST(NULL AS {kind}) AS `{c}`" for c in names if c not in have]
    return df.selectExpr("*", *missing) if missing else df


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Strict ``old -> new``: an absent column is an error."""
    absent = [c for c in mapping if c not in df.columns]
    if absent:
        raise ValueError(f"cannot rename absent columns {absent}")
    return df.withColumnsRenamed(dict(mapping))


def rename_if_present(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns and v not in df.columns})


def shadow(df: DataFrame, names: Iterable[str], prefix: str = "raw_") -> DataFrame:
    """Set the annotator's own columns aside before looked-up columns take their names."""
    return df.withColumnsRenamed({c: prefix + c for c in names})


def empty_columns(df: DataFrame) -> list[str]:
    """Columns without a single value: one aggregate over the table, one row back."""
    filled = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if filled[c] == 0]


def drop_all_null(df: DataFrame) -> DataFrame:
    """Drop columns that are NULL throughout. Runs a job: use it at ingest, not inside a plan."""
    return df.drop(*empty_columns(df))


def with_row_id(df: DataFrame, name: str = "id") -> DataFrame:
    """Unique, increasing ids without a global sort (they are not consecutive)."""
    return df.withColumn(name, F.monotonically_increasing_id())


def with_row_number(df: DataFrame, name: str = "id") -> DataFrame:
    """1 to n in the order of the files' paths and of the rows in them, for a table that is read from files (and filtered or projected, no more).

    Two passes: rows and first running id of each block of a file, summed up over the blocks; then each row's place behind the start of its block. No row is
    moved; the only thing in one place is one row for each block.
    """
    hidden, taken = df.metadataColumn("_metadata"), set(df.columns)
    block = [hidden["file_path"].alias("__path"), hidden["file_block_start"].alias("__start")]
    rows = df.select("*", *block, F.monotonically_increasing_id().alias("__mid"))
    blocks = rows.groupBy("__path", "__start").agg(F.count(F.lit(1)).alias("__rows"), F.min("__mid").alias("__first"))
    before = F.coalesce(F.sum("__rows").over(W.orderBy("__path", "__start").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.select("__path", "__start", (before - F.col("__first") + 1).alias("__shift"))
    out = rows.join(blocks, ["__path", "__start"]).withColumn(name, F.col("__mid") + F.col("__shift"))
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c in taken and c != name], name)


def path_columns(path: Column, root: str, into: Sequence[str] = ("project", "campaignid")) -> list[Column]:
    """Folder names below ``root`` as columns; deeper folders are dropped, missing ones NULL."""
    plain = F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    below = F.get(F.split(plain, re.escape(root.rstrip("/") + "/"), 2), F.lit(1))
    parts = F.split(below, "/")
    # The last piece is the file itself, never a folder name.
    return [
        F.when(F.size(parts) > i + 1, F.get(parts, F.lit(i))).alias(name) for i, name in enumerate(into)
    ]


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Bag union by column name; a column missing on one side is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
