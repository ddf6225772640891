"""The benchmark tables written as the raw files that real campaigns deliver.

Used by the scan queries and tests: exports with lines before the header, headers that differ from
file to file, metadata in two spellings.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.columns import union_by_name
from ..operators.joins import lookup
from ..sources.files import Files, partition_value
from ..sources.sinks import scratch_dir
from . import frames as fr

ROWS_PER_FILE = 500_000
PREAMBLE = ["Measurements", "", "Created by a test", "Units: dots"]


def _line(columns: Sequence[str], sep: str) -> Column:
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    if sep == ",":
        cells = [F.when(F.contains(c, F.lit(",")), F.concat(F.lit('"'), c, F.lit('"'))).otherwise(c) for c in cells]
    return F.concat_ws(sep, *cells)


def write_raw(
    df: DataFrame, root: str, folders: Sequence[str], header: Mapping[str, str], preamble: Sequence[str], sep: str
) -> None:
    """Text files below ``folders``, each starting with the preamble and the header.

    A folder gets as many files as its rows need, spread by the rows' whole content (also what is not written), so that
    neither a big campaign nor a frequent line is one task's work. There are as many tasks as files.
    """
    sizes = df.groupBy(*folders).agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_FILE).alias("__files"))
    # Stored, so that its size is known when the join is planned: rows then go through one exchange, not two.
    counted = scratch_dir(df.sparkSession, "files")
    sizes.write.parquet(counted)
    sizes = df.sparkSession.read.schema(sizes.schema).parquet(counted)
    n_files = sizes.agg(F.sum("__files")).first()[0] or 1
    row = lookup(df, sizes, list(folders), "inner").select(
        *folders, F.pmod(F.xxhash64(*df.columns), F.col("__files")).alias("file"),
        F.lit(len(preamble) + 1).alias("__n"), _line(list(header), sep).alias("value"),
    )
    first = F.array(*[F.lit(x) for x in [*preamble, sep.join(header.values())]])
    opening = row.select(*folders, "file").distinct().select(*folders, "file", F.posexplode(first).alias("__n", "value"))
    keys = [*folders, "file"]
    lines = union_by_name(row, opening).repartition(n_files, *keys).sortWithinPartitions(*keys, "__n").drop("__n")
    lines.write.mode("append").partitionBy(*keys).text(root)


def write_exports(spark: SparkSession, d: str, root: str) -> None:
    """Both camera directions of every campaign; their headers differ in order and names."""
    pts = fr.points(spark, d)
    forwards = {"filename": "Filename", "caab_code": "CODE", "broad": "Broad", "relief": "Relief", "type": "Type"}
    backwards = {"broad": "BROAD", "filename": '"Filename"', "morphology": "Morphology", "caab_code": "Code"}
    for direction, header in (("forwards", forwards), ("backwards", backwards)):
        side = pts.filter(F.col("direction") == direction).withColumn("direction", F.lit(direction))
        write_raw(side, root, ["campaignid", "direction"], header, PREAMBLE, "\t")


def write_metadata_files(spark: SparkSession, d: str, root: str) -> None:
    """Metadata below project and campaign folders, in two header spellings."""
    meta = fr.metadata(spark, d).select(
        F.concat(F.lit("Project "), F.col("location")).alias("project"), "campaignid", "sample", "latitude_dd",
        F.concat(F.lit("north, "), F.col("location")).alias("location"), "successful_count", "successful_length",
    )
    old = {"sample": '"Sample"', "latitude_dd": '"Latitude"', "location": '"Location"',
           "successful_count": '"Successful.count"', "successful_length": '"Successful.length"'}
    new = {"location": "location", "sample": "opcode", "successful_length": "successful_length",
           "successful_count": "successful_count", "latitude_dd": "latitude"}
    recent = F.col("campaignid").isin("survey-1", "survey-2")
    for side, header in ((meta.filter(recent), new), (meta.filter(~recent), old)):
        write_raw(side, root, ["project", "campaignid"], header, [], ",")


def land(spark: SparkSession, df: DataFrame, staged: str, box: str, header: Mapping[str, str], name: str, sep: str = "\t", days_old: int = 0) -> None:
    """``df`` as files ``project/campaign/name-i...`` of a landing folder; files of that name are replaced. ``days_old`` sets their times back."""
    write_raw(df, staged, ["campaignid"], header, PREAMBLE if sep == "\t" else [], sep)
    files = Files(spark, box)
    for path in files.files_below(staged):
        parts = path.split("/")
        if not parts[-1].startswith("part-"):
            continue
        campaignid, number = partition_value(parts[-3]), partition_value(parts[-2])
        target = f"{box}/survey project/{campaignid}/{name}-{number}{ENDINGS[sep]}"
        files.move(path, target)
        if days_old:
            files.set_time(target, int((time.time() - 86_400 * days_old) * 1000))


def withdraw(spark: SparkSession, box: str, name: str) -> None:
    files = Files(spark, box)
    for path in files.files_below(box):
        if path.rsplit("/", 1)[1].startswith(f"{name}-"):
            files.delete(path)


ENDINGS = {"\t": "_Dot Point Measurements.txt", ",": "_Metadata.csv"}
