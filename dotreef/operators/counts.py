"""Counting. One narrow pre-aggregation comes first; labels are attached to its result."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import not_in_set
from ..schemas import CODE, LABELS
from .joins import lookup, semi_on, tagged_keys

UNSCORABLE = ("", "Unscorable", None)

MULT = "__mult"
#: Rows that a folded row stands for.
FOLDED = "__n"


def folded(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Dots folded on the columns that several plans look at. All of them then share one exchange and one scan.

    The test of the count keeps it in every branch, so that the branches stay the same plan up to there.
    """
    return points.groupBy(*keys).agg(F.count(F.lit(1)).alias(FOLDED)).filter(F.col(FOLDED) > 0)


def keep(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that meet the condition. Folded rows are weighed by it instead: a filter on their keys would go below the fold and make it another plan."""
    if FOLDED not in df.columns:
        return df.filter(condition)
    weight = F.col(FOLDED) * F.coalesce(condition, F.lit(False)).cast("bigint")
    return df.withColumn(FOLDED, weight).filter(F.col(FOLDED) > 0)


def scorable(df: DataFrame, column: str = "level_2", drop: Iterable = UNSCORABLE) -> DataFrame:
    return df.filter(not_in_set(column, drop))


def tally(df: DataFrame, keys: Sequence[str], weight: str | None = None, name: str = "count") -> DataFrame:
    """Rows per group, or the sum of ``weight``. NULL is a group like any other, a folded row counts for all that it stands for."""
    if weight is None and FOLDED in df.columns:
        weight = FOLDED
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(*keys).agg(n.cast("bigint").alias(name))


def sum_na_rm(df: DataFrame, keys: Sequence[str], column: str, name: str | None = None) -> DataFrame:
    """Sum that skips NULL and is 0, not NULL, where every value is NULL."""
    total = F.coalesce(F.sum(column), F.lit(0).cast(df.schema[column].dataType))
    return df.groupBy(*keys).agg(total.alias(name or column))


def distinct_per_group(df: DataFrame, group: Sequence[str], value: str, name: str) -> DataFrame:
    """Distinct values per group, NULL being one of them (``count_distinct`` would skip it)."""
    return df.select(*group, value).distinct().groupBy(*group).agg(F.count(F.lit(1)).alias(name))


def first_by(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The whole row with the smallest ``order`` per key, NULL ``order`` last.

    A ``min`` over a struct, so it folds before the exchange; a window would sort every
    group whole. Ties fall to the smallest remaining values, never to arrival order.
    """
    rest = [c for c in df.columns if c not in keys and c != order]
    row = F.struct(F.col(order).isNull().alias("__last"), F.col(order), *[F.col(c) for c in rest])
    best = df.groupBy(*keys).agg(F.min(row).alias("__row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def multiplicity(dim: DataFrame) -> DataFrame:
    """Fold repeated rows of a lookup table into one row and a factor."""
    return dim.groupBy(*dim.columns).agg(F.count(F.lit(1)).alias(MULT))


def label_counts(
    points: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    by: Sequence[str],
    labels: Sequence[str] = tuple(LABELS),
    with_code: bool = True,
    drop: Iterable = UNSCORABLE,
    drop_on: str = "level_2",
    where: Column | None = None,
    name: str = "count",
    weight: str | None = None,
) -> DataFrame:
    """Count points per ``by`` and class, class labels taken from ``dim`` through ``on``.

    ``points`` are folded on ``by + on`` first: that is the one exchange that sees raw rows, on a
    few narrow columns, and a hot sample or class arrives as one row per task. The lookup
    then joins counts, not points; repeated lookup rows multiply the count, as a
    row-by-row join would. When the key ``on`` is among the output columns, distinct
    lookup rows give distinct output rows and no second aggregation is needed.
    """
    folded = tally(points, [*by, *on], weight, "__n")
    wide = lookup(folded, multiplicity(dim), list(on))
    wide = wide.withColumn("__n", F.col("__n") * F.coalesce(F.col(MULT), F.lit(1))).drop(MULT)
    present = [c for c in labels if c in wide.columns]
    if drop is not None:
        # ``__n`` is the weight here: where the points came folded, their fold stays the plan that others share.
        wide = keep(wide, not_in_set(drop_on, drop)) if FOLDED in points.columns else scorable(wide, drop_on, drop)
    if where is not None:
        wide = wide.filter(where)
    keys = [*by, *present] + ([CODE] if with_code and CODE not in present and CODE in wide.columns else [])
    left_out = [c for c in wide.columns if c not in keys and c != "__n"]
    if not left_out:
        return wide.select(*keys, F.col("__n").alias(name))
    return tally(wide, keys, "__n", name)


def resolve_counts(
    points: DataFrame,
    classes: Sequence[str],
    resolve: Callable[[DataFrame], DataFrame],
    by: Sequence[str],
    keys: Sequence[str],
    keep: Column | None = None,
    name: str = "count",
) -> DataFrame:
    """Count points whose class needs work: ``resolve`` runs once per distinct class.

    ``resolve`` may change or multiply classes, ``keep`` then says which of them count. The
    points are folded once, and both the distinct classes and the counts come from that fold. A
    vocabulary is small however many dots use it.
    """
    folded = tally(points, [*by, *classes], name="__n")
    raw = [f"__raw_{c}" for c in classes]
    # Summed and tested so that the fold is the same plan on both sides: one exchange serves both.
    seen = folded.groupBy(*classes).agg(F.sum("__n").alias("__seen")).filter("__seen > 0").drop("__seen")
    shadowed = [f"`{c}` AS `{r}`" for c, r in zip(classes, raw)]
    done = resolve(seen.selectExpr(*shadowed, *classes))
    present = [k for k in keys if k in done.columns]
    # Counting the kept rows instead of filtering: a filter would be pushed below the distinct
    # and work out every label for every point after all.
    kept = F.count(F.lit(1)) if keep is None else F.count(F.when(keep, 1))
    done = done.groupBy(*raw, *present).agg(kept.alias(MULT)).filter(F.col(MULT) > 0)
    found = lookup(folded.selectExpr(*by, *shadowed, "__n"), done, raw, "inner")
    return found.groupBy(*by, *present).agg(F.expr(f"sum(__n * {MULT})").alias(name))


def wide_to_long(
    df: DataFrame,
    prefix: str,
    ids: Sequence[str],
    names_to: str,
    values_to: str = "count",
) -> DataFrame:
    """Count matrix to rows. NULL cells stay rows; cells that are no number become NULL."""
    cells = [c for c in df.columns if c.startswith(prefix)]
    numbers = df.select(*ids, *[F.col(c).try_cast("double").alias(c) for c in cells])
    return numbers.unpivot(list(ids), cells, names_to, values_to)


def from_literal(column: str, table: Mapping, kind: str = "string") -> Column:
    """A small fixed table as one map literal: no join, nothing to broadcast."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), F.col(column)).cast(kind)


def scope(counts: DataFrame, metadata: DataFrame, on: Sequence) -> DataFrame:
    """Keep the counts whose sample is in (possibly filtered) metadata."""
    return semi_on(counts, metadata, on)


def coverage_summary(
    relief: DataFrame,
    benthos: DataFrame,
    group: Sequence[str] = ("campaignid",),
    sample: str = "sample",
) -> DataFrame:
    """Samples with relief and with benthos per campaign; NULL where a campaign has none.

    Two aggregations over one union replace two distincts, two counts and a full join.
    """
    both = tagged_keys({"__r": relief, "__b": benthos}, [*group, sample])
    return both.groupBy(*group).agg(
        F.nullif(F.count("__r"), F.lit(0)).alias("relief_sample"),
        F.nullif(F.count("__b"), F.lit(0)).alias("benthos_sample"),
    )


def class_coverage(relief: DataFrame, benthos: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows (classes) per sample in each output, side by side."""
    one = F.lit(1).cast("bigint")
    none = F.lit(None).cast("bigint")
    rows = relief.select(*keys, one.alias("__r"), none.alias("__b")).unionByName(
        benthos.select(*keys, none.alias("__r"), one.alias("__b"))
    )
    return rows.groupBy(*keys).agg(F.sum("__r").alias("relief_sample"), F.sum("__b").alias("benthos_sample"))
