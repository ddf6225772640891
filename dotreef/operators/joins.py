"""Null-matching joins.

A NULL key matches a NULL key. The keys travel as one struct: struct equality treats
NULL fields as equal, stays an ordinary hash or sort-merge equi-join, and - unlike a list of
``<=>`` terms - lets a ``distinct`` on the same struct hand its partitioning to the join.

Nothing here is hinted ``broadcast``: Spark compares each side with
``spark.sql.autoBroadcastJoinThreshold`` (and again with real sizes at run time) and
sort-merges what is larger. A hot key of the left side is then cut by the skew join of adaptive
execution, between the map tasks that wrote it, so wholly identical rows are spread as well.
Neither side is repeated beforehand: what is materialised is what the planner estimated.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import union_by_name

log = logging.getLogger(__name__)

Key = str | tuple[str, str]


def _pairs(on: Key | Sequence[Key]) -> list[tuple[str, str]]:
    on = [on] if isinstance(on, str) else list(on)
    return [(k, k) if isinstance(k, str) else k for k in on]


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _key_sql(names: Sequence[str], types: Sequence[str]) -> str:
    fields = [f"CAST({_q(n)} AS {t}) AS k{i}" for i, (n, t) in enumerate(zip(names, types))]
    return f"struct({', '.join(fields)})"


_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _common(a: str, b: str) -> str:
    """The type in which two key types are compared."""
    if a == b:
        return a
    number = lambda t: t in _WHOLE or t in ("float", "double") or t.startswith("decimal")
    if a in _WHOLE and b in _WHOLE:
        return "bigint"
    if number(a) and number(b):
        return "double"
    if {a, b} <= {*_WHOLE, "string"}:
        return "string"
    if {a, b} <= {"date", "timestamp"}:
        return "timestamp"
    raise TypeError(f"join keys of types {a} and {b} have no common form")


def _key_types(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> list[str]:
    lt, rt = dict(left.dtypes), dict(right.dtypes)
    return [_common(lt[lk], rt[rk]) for lk, rk in pairs]


_SAME_KEY = "__lk = __rk"


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: Key | Sequence[Key],
    how: str = "left",
    suffix: str = "_right",
    unique: bool = False,
) -> DataFrame:
    """Left (or inner) join that keeps the left key once and may fan out.

    Other columns present on both sides get ``suffix`` on the right one. With ``unique`` a key that occurs more than once on the right is an error, raised
    where a row of the left side meets it; ``fan_outs`` lists such keys beforehand.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    pairs = _pairs(on)
    types = _key_types(left, right, pairs)
    lkeys, rkeys = [p[0] for p in pairs], [p[1] for p in pairs]
    mine = left.columns
    brought = [(c, c + suffix if c in mine else c) for c in right.columns if c not in rkeys]
    r = right.selectExpr(
        f"{_key_sql(rkeys, types)} AS __rk", *[f"{_q(a)} AS {_q(b)}" for a, b in brought]
    )
    if unique:
        r = r.groupBy("__rk").agg(F.count(F.lit(1)).alias("__copies"), F.first(F.struct(F.lit(1).alias("__one"), *[F.col(_q(b)) for _, b in brought])).alias("__row"))
    l = left.selectExpr("*", f"{_key_sql(lkeys, types)} AS __lk")
    out = l.join(r, F.expr(_SAME_KEY), how)
    if not unique:
        return out.selectExpr(*map(_q, mine), *[_q(b) for _, b in brought])
    # Checked on joined rows: keys that nobody looks up may repeat. The filter keeps the check whatever columns are read, the
    # partition (never below 0) keeps the filter above the join.
    told = "raise_error(concat('lookup key ', to_json(__lk), ' occurs ', __copies, ' times'))"
    out = out.filter(F.expr(f"coalesce(CASE WHEN __copies > 1 AND spark_partition_id() >= 0 THEN {told} ELSE true END, true)"))
    return out.selectExpr(*map(_q, mine), *[f"__row.{_q(b)} AS {_q(b)}" for _, b in brought])


def fan_outs(left: DataFrame, right: DataFrame, on: Key | Sequence[Key]) -> DataFrame:
    """Keys of ``left`` that a lookup in ``right`` would multiply: the key, ``rows`` of the left side and ``copies`` on the right. NULL matches NULL."""
    pairs = _pairs(on)
    types = _key_types(left, right, pairs)
    lkeys, rkeys = [p[0] for p in pairs], [p[1] for p in pairs]
    l = left.selectExpr(f"{_key_sql(lkeys, types)} AS __lk").groupBy("__lk").agg(F.count(F.lit(1)).alias("rows"))
    r = right.selectExpr(f"{_key_sql(rkeys, types)} AS __rk").groupBy("__rk").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    keys = [f"__lk.k{i} AS {_q(k)}" for i, k in enumerate(lkeys)]
    return l.join(r, F.expr(_SAME_KEY)).selectExpr(*keys, "rows", "copies")


def counted_lookup(points: DataFrame, right: DataFrame, on: Key | Sequence[Key], name: str) -> DataFrame:
    """Rows per key, then the columns of ``right`` for it.

    The rows are counted by the key struct itself, so a sort-merge join finds the counts already
    partitioned the way it needs them.
    """
    pairs = _pairs(on)
    types = _key_types(points, right, pairs)
    lkeys, rkeys = [p[0] for p in pairs], [p[1] for p in pairs]
    n = F.count(F.lit(1)).alias(name)
    l = points.selectExpr(f"{_key_sql(lkeys, types)} AS __lk").groupBy("__lk").agg(n)
    rest = [c for c in right.columns if c not in rkeys]
    r = right.selectExpr(f"{_key_sql(rkeys, types)} AS __rk", *map(_q, rest))
    keys = [f"__lk.k{i} AS {_q(k)}" for i, k in enumerate(lkeys)]
    return l.join(r, F.expr(_SAME_KEY), "left").selectExpr(*keys, _q(name), *map(_q, rest))


def _filtering(left: DataFrame, right: DataFrame, on, how: str) -> DataFrame:
    pairs = _pairs(on)
    types = _key_types(left, right, pairs)
    # Only the distinct keys of the right side travel; the partial aggregation before the
    # exchange folds a hot key to one row per task.
    keys = right.selectExpr(f"{_key_sql([p[1] for p in pairs], types)} AS __rk").distinct()
    l = left.selectExpr("*", f"{_key_sql([p[0] for p in pairs], types)} AS __lk")
    return l.join(keys, F.expr(_SAME_KEY), how).selectExpr(*map(_q, left.columns))


def semi_on(left: DataFrame, right: DataFrame, on: Key | Sequence[Key]) -> DataFrame:
    """Rows of ``left`` with a partner; never multiplied."""
    return _filtering(left, right, on, "left_semi")


def anti_on(left: DataFrame, right: DataFrame, on: Key | Sequence[Key]) -> DataFrame:
    """Rows of ``left`` without a partner; all of them, duplicates too."""
    return _filtering(left, right, on, "left_anti")


def shared_columns(left: DataFrame, right: DataFrame) -> list[str]:
    return [c for c in left.columns if c in right.columns]


def natural_join(left: DataFrame, right: DataFrame, how: str = "left", unique: bool = False) -> DataFrame:
    """Join on every column the two sides share; the keys are logged because they are implicit. ``unique`` as in ``lookup``."""
    keys = shared_columns(left, right)
    if not keys:
        raise ValueError("the two sides share no column")
    log.info("natural %s join on %s", how, keys)
    if how == "left_semi":
        return semi_on(left, right, keys)
    if how == "left_anti":
        return anti_on(left, right, keys)
    return lookup(left, right, keys, how, unique=unique)


def full_on(left: DataFrame, right: DataFrame, on: Key | Sequence[Key]) -> DataFrame:
    """Full outer join with one coalesced key set. Meant for summaries, not for raw rows."""
    pairs = _pairs(on)
    types = _key_types(left, right, pairs)
    lkeys, rkeys = [p[0] for p in pairs], [p[1] for p in pairs]
    lrest = [c for c in left.columns if c not in lkeys]
    rrest = [c for c in right.columns if c not in rkeys]
    clash = set(lrest) & set(rrest)
    if clash:
        raise ValueError(f"both sides carry {sorted(clash)}")
    l = left.selectExpr(f"{_key_sql(lkeys, types)} AS __lk", *map(_q, lrest))
    r = right.selectExpr(f"{_key_sql(rkeys, types)} AS __rk", *map(_q, rrest))
    keys = [f"coalesce(__lk, __rk).k{i} AS {_q(n)}" for i, n in enumerate(lkeys)]
    return l.join(r, F.expr(_SAME_KEY), "full").selectExpr(*keys, *map(_q, lrest), *map(_q, rrest))


def tagged_keys(frames: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Distinct keys over several tables with one presence flag per table (true or NULL).

    One partial-then-final aggregation over a union: it does the work of a distinct per
    side plus a full join with a single exchange, and a hot key folds before it.
    """
    parts = [df.select(*keys, F.lit(True).alias(flag)) for flag, df in frames.items()]
    return union_by_name(*parts).groupBy(*keys).agg(*[F.max(flag).alias(flag) for flag in frames])


def presence_diff(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    flags: tuple[str, str] = ("in_habitat", "in_metadata"),
) -> DataFrame:
    """Keys found on one side only."""
    both = tagged_keys({flags[0]: left, flags[1]: right}, keys)
    return both.filter(F.col(flags[0]).isNull() | F.col(flags[1]).isNull())


def value_setdiff(left: DataFrame, right: DataFrame, on: Key) -> DataFrame:
    """Distinct values of ``left`` that ``right`` lacks."""
    lk, rk = (on, on) if isinstance(on, str) else on
    both = tagged_keys({"__l": left.select(lk), "__r": right.select(F.col(rk).alias(lk))}, [lk])
    return both.filter(F.col("__l") & F.col("__r").isNull()).select(lk)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that would make a lookup fan out, with how often they occur."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)
