"""Classification and crosswalk tables."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .. import fixed
from ..functions.nulls import try_number
from ..operators.columns import with_clean_names
from ..schemas import CLASSIFICATION, CODE, LEVELS, conform


def literal_table(spark: SparkSession, rows: Sequence[tuple], struct: T.StructType) -> DataFrame:
    """A small fixed table. Handed over as Arrow it is a local relation of known size."""
    arrays = [[r[i] for r in rows] for i in range(len(struct.fields))]
    schema = to_arrow_schema(struct)
    return spark.createDataFrame(pa.table([pa.array(a, f.type) for a, f in zip(arrays, schema)], schema=schema), struct)


def _read(spark: SparkSession, path: str) -> DataFrame:
    if path.rstrip("/").endswith((".csv", ".csv.gz")):
        return with_clean_names(spark.read.csv(path, header=True, nullValue="NA"))
    return spark.read.parquet(path)


def read_classification(spark: SparkSession, path: str) -> DataFrame:
    """The class table: whole-number codes, qualifiers dropped, empty labels kept as they are."""
    return conform(_read(spark, path).drop("qualifiers"), CLASSIFICATION)


def read_crosswalk(spark: SparkSession, path: str) -> DataFrame:
    """A snapshot of a crosswalk sheet, without repeated rows."""
    raw = _read(spark, path).drop("qualifiers")
    return (raw.withColumn(CODE, try_number(CODE)) if CODE in raw.columns else raw).distinct()


def labels_by_code(spark: SparkSession) -> DataFrame:
    struct = T.StructType(CLASSIFICATION.fields[:6])
    return literal_table(spark, fixed.LABELS_BY_CODE, struct)


def starter_classification(spark: SparkSession) -> DataFrame:
    """The classes this package knows itself: relief, common substrates and a few biota groups."""
    whole = [r for r in fixed.LABELS_BY_CODE if r[1] is not None]
    rows = [*fixed.RELIEF_CLASSES, *fixed.KNOWN_CLASSES, *whole]
    struct = T.StructType(CLASSIFICATION.fields[: 1 + len(LEVELS[:5])])
    return conform(literal_table(spark, rows, struct), CLASSIFICATION)
