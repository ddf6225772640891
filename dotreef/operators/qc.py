"""Checks. Each is a DataFrame of findings; an empty one means all is well."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import try_number
from ..schemas import CODE
from .counts import FOLDED, folded  # noqa: F401  (checks fold first)
from .joins import anti_on, counted_lookup, lookup, natural_join, value_setdiff

#: A sample id is unique within its campaign only.
BY = ("campaignid", "sample")


def points_per_sample(points: DataFrame, metadata: DataFrame, on: Sequence[str] = BY) -> DataFrame:
    """Dots per sample next to its metadata; counted before joining."""
    return counted_lookup(points, metadata, list(on), "points_annotated")


def expected_points(per_image: int | Column, forward: str, backward: str) -> Column:
    """Dots that should be there: one image's worth per successful direction, NULL if unknown."""

    def one(c: str) -> Column:
        return F.when(F.col(c) == "Yes", 1).when(F.col(c) == "No", 0)

    per_image = per_image if isinstance(per_image, Column) else F.lit(per_image)
    return (per_image * (one(forward) + one(backward))).cast("bigint")


def wrong_point_counts(
    points: DataFrame,
    metadata: DataFrame,
    per_image: int | Column,
    forward: str = "successful_habitat_forward",
    backward: str = "successful_habitat_backward",
    on: Sequence[str] = BY,
) -> DataFrame:
    """Samples whose dot count differs from the expected one; unknown expectations pass."""
    counted = points_per_sample(points, metadata, on)
    return counted.withColumn("expected", expected_points(per_image, forward, backward)).filter(
        F.col("points_annotated") != F.col("expected")
    )


def annotations_missing_metadata(
    points: DataFrame, metadata: DataFrame, on: Sequence = BY
) -> DataFrame:
    """Every annotation row of a sample that metadata does not know."""
    return anti_on(points, metadata, list(on))


def was_successful() -> Column:
    return (F.col("successful_count") == "Yes") | (F.col("successful_length") == "Yes")


def successful(metadata: DataFrame) -> DataFrame:
    return metadata.filter(was_successful())


def metadata_missing_annotations(
    metadata: DataFrame, points: DataFrame, on: Sequence = BY, only_successful: bool = False
) -> DataFrame:
    """Deployments without annotations, optionally only those that should have some."""
    return anti_on(successful(metadata) if only_successful else metadata, points, list(on))


def missing_codes(points: DataFrame, classes: Sequence[str], code: str = CODE) -> DataFrame:
    """Distinct classes with a dot that has no code. Counted, not filtered first: a fold shared with other checks stays shared."""
    missing = F.count(F.when(F.col(code).isNull(), 1)).alias("__missing")
    return points.groupBy(*classes).agg(missing).filter("__missing > 0").drop("__missing")


def unmatched_classes(
    points: DataFrame, table: DataFrame, classes: Sequence[str], value: str, keys: Sequence[str] | None = None
) -> DataFrame:
    """Distinct classes that ``table`` gives no ``value``; the points are folded to classes first."""
    keys = list(keys or classes)
    found = table.select(*keys, F.col(value).alias("__value")).distinct()
    seen = points.select(*dict.fromkeys([*classes, *keys])).distinct()
    return lookup(seen, found, keys).filter(F.col("__value").isNull()).select(*classes).distinct()


def missing_in_schema(points: DataFrame, schema: DataFrame) -> DataFrame:
    """Rows whose shared columns, taken together, are no row of the schema."""
    return natural_join(points, schema, "left_anti")


def distinct_classes(points: DataFrame, classes: Sequence[str]) -> DataFrame:
    return points.select(*classes).distinct()


def missing_opcode(points: DataFrame, opcode: str = "opcode", show: Sequence[str] = ("filename", "direction")) -> DataFrame:
    return points.filter(F.col(opcode).isNull()).select(*show).distinct()


def campaign_id_diff(counts: DataFrame, metadata: DataFrame, column: str = "campaignid") -> DataFrame:
    return value_setdiff(counts, metadata, column)


def unparseable_codes(points: DataFrame, column: str) -> DataFrame:
    return points.filter(try_number(column).isNull()).select(column).distinct()


def schema_browse(schema: DataFrame, columns: Sequence[str], **equal: str) -> DataFrame:
    """Classes with the given labels, in order."""
    out = schema
    for column, value in equal.items():
        out = out.filter(F.col(column) == value)
    return out.select(*columns).distinct().orderBy(*[F.col(c).asc_nulls_last() for c in columns])


def unique_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values, without NULL."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def profile(df: DataFrame) -> DataFrame:
    """Rows and filled cells per column, in one pass."""
    cols = df.columns
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(F.col(c)).alias(f"f{i}") for i, c in enumerate(cols)],
    )
    items = [
        F.struct(F.lit(c).alias("column"), F.col("rows"), F.col(f"f{i}").alias("filled")) for i, c in enumerate(cols)
    ]
    return row.select(F.inline(F.array(*items)))


def qc_report(checks: dict[str, DataFrame]) -> DataFrame:
    """Findings per check, zero included: the row-count guard as data instead of a warning."""
    parts = [
        df.agg((F.coalesce(F.sum(FOLDED), F.lit(0)) if FOLDED in df.columns else F.count(F.lit(1))).alias("findings")).select(F.lit(name).alias("check"), "findings")
        for name, df in checks.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
