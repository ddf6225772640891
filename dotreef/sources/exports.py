"""Annotation exports to the table of dots: campaign, camera direction and kind come from where a file lies and what it is called."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.columns import path_columns
from .ragged import PATH, read_annotations

# How exports are told apart by name.
BACKWARDS, FORWARDS = r"(?i)backwards?", r"(?i)forwards?"
RELIEF = r"(?i)(?:relief|(?<![a-z])grid(?![a-z]))"


def _name(path: Column, folders: int) -> Column:
    """The path below the named folders, so that a campaign's own name says nothing about a file."""
    parts = F.split(path, "/")
    return F.concat_ws("/", F.slice(parts, F.lit(folders + 1), F.greatest(F.size(parts) - folders, F.lit(0))))


def direction(name: Column) -> Column:
    return F.when(F.regexp_like(name, F.lit(BACKWARDS)), "backwards").when(F.regexp_like(name, F.lit(FORWARDS)), "forwards")


def kind(name: Column) -> Column:
    return F.when(F.regexp_like(name, F.lit(RELIEF)), "relief").otherwise("benthos")


def ingest(
    spark: SparkSession, root: str, columns: Sequence[str], folders: Sequence[str] = ("project", "campaignid"),
    glob: str = "*_Dot Point Measurements.txt",
) -> DataFrame:
    """All exports below ``root`` as dots: ``columns`` as text, the folder names, ``direction`` and ``kind``.

    An export whose name gives no direction has NULL there; one that does not name relief is benthos. Store the result with ``store_points``.
    """
    below = F.regexp_replace(F.col(PATH), "^[a-z0-9]+:/+", "/")
    start = "/" + root.split("://", 1)[-1].strip("/").removeprefix("file:").strip("/") + "/"
    name = _name(F.substring_index(below, start, -1), len(folders))
    of_path = [*path_columns(F.col(PATH), root, folders), direction(name).alias("direction"), kind(name).alias("kind")]
    return read_annotations(spark, root, columns=columns, glob=glob, of_path=of_path).drop(PATH)
