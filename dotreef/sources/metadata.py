"""Sample metadata: one CSV per campaign folder, headers in any order and case."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.columns import path_columns
from ..schemas import METADATA, conform
from .ragged import PATH, scan_ragged

# --- fixed values: other spellings of the canonical columns ---------------------------------
SPELLINGS = {
    "latitude": "latitude_dd",
    "longitude": "longitude_dd",
    "depth": "depth_m",
    "comments": "comment",
    "successful_habitat_forwards": "successful_habitat_forward",
    "successful_habitat_backwards": "successful_habitat_backward",
}
SYNTHESIS = [
    "project", "campaignid", "sample", "latitude", "longitude", "date", "time", "location", "status", "site",
    "depth", "observer", "successful_count", "successful_length", "comment",
]


def _campaign_files(spark: SparkSession, root: str, glob: str, columns: list[str]) -> DataFrame:
    raw = scan_ragged(spark, root, sep=",", skip=0, glob=glob, columns=columns, na=("", "NA"), trim=True)
    return raw.select(*columns, *path_columns(F.col(PATH), root))


def synthesise_metadata(spark: SparkSession, root: str, glob: str = "*_Metadata.csv") -> DataFrame:
    """All campaigns below ``root`` as text: project and campaign come from the folder names.

    A file's own campaign column is ignored. ``opcode`` stands for ``sample`` where a file has
    no ``sample``.
    """
    wanted = [c for c in SYNTHESIS if c not in ("project", "campaignid")]
    raw = _campaign_files(spark, root, glob, [*wanted, "opcode"])
    return raw.withColumn("sample", F.coalesce("sample", "opcode")).select(*SYNTHESIS)


def read_metadata(spark: SparkSession, root: str, glob: str = "*etadata.csv", campaign_level: bool = True) -> DataFrame:
    """Canonical, typed metadata. Spellings are merged, numbers and times parsed or NULL.

    With ``campaign_level`` the folders directly below ``root`` are campaigns; otherwise
    ``root`` holds project folders with campaign folders in them.
    """
    spellings = {**SPELLINGS, **{v: v for v in SPELLINGS.values()}}
    plain = [f.name for f in METADATA.fields if f.name not in ("project", "campaignid", "date_time", *SPELLINGS.values())]
    columns = list(dict.fromkeys([*plain, "opcode", "period", *spellings]))
    into = ("campaignid",) if campaign_level else ("project", "campaignid")
    raw = scan_ragged(spark, root, sep=",", skip=0, glob=glob, columns=columns, na=("", "NA"), trim=True)
    raw = raw.select(*columns, *path_columns(F.col(PATH), root, into))
    merged = {new: F.coalesce(F.col(new), F.col(old)) for old, new in SPELLINGS.items()}
    merged["sample"] = F.coalesce("sample", "opcode", "period")
    out = raw.withColumns(merged).withColumn("date_time", date_time("date", "time"))
    return conform(out, METADATA)


def date_time(date: str, time: str):
    """``20210518`` and ``12:28`` or ``12:28:05`` to a timestamp, NULL when either is odd."""
    text = F.concat_ws(" ", F.col(date), F.col(time))
    known = F.col(date).isNotNull() & F.col(time).isNotNull()
    parsed = F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyyMMdd H:mm:ss")), F.try_to_timestamp(text, F.lit("yyyyMMdd H:mm"))
    )
    return F.when(known, parsed)
