"""Upload tables and intermediate storage."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cache, reduce

from py4j.protocol import Py4JError, Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columns import rename
from .files import Files, literal, partition_value

#: Rows that one task sorts for a file of its own campaign.
ROWS_PER_PIECE = 500_000


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="dotreef-")


#: Scratch folders of this process that have not been dropped.
_made: list[str] = []


@cache
def _at_exit(files: Files) -> None:
    """What a run has left in the shared folder goes when its process ends."""

    def clean() -> None:
        for path in _made:
            try:
                files.delete(path)
            except (Py4JError, OSError):  # Spark is gone already; nothing can be reached any more
                return

    atexit.register(clean)


def drop_scratch(spark: SparkSession, since: int = 0, keep: Sequence[str] = ()) -> None:
    """Deletes the scratch folders made after the first ``since`` ones; results that still read them must not be used any more."""
    for path in [p for p in _made[since:] if p not in keep]:
        Files(spark, path).delete(path)
        _made.remove(path)


def scratch_count() -> int:
    return len(_made)


def scratch_dir(spark: SparkSession, name: str = "") -> str:
    """A new folder below the shared one the session names; a local one only where all tasks run on this machine.

    It is deleted when the process ends, or by ``drop_scratch``.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to a folder that every executor of {master} sees")
        shared = _local_folder()
    path = f"{shared.rstrip('/')}/{uuid.uuid4().hex}" + (f"-{name}" if name else "")
    _at_exit(_files(spark, shared))
    _made.append(path)
    return path


@cache
def _files(spark: SparkSession, root: str) -> Files:
    return Files(spark, root)


def write_upload(
    df: DataFrame,
    path: str,
    kind: str,
    rename_sample: str | None = None,
    quote_all: bool = False,
    order: Sequence[str] = (),
    mode: str = "overwrite",
    watch: Mapping[str, Column] | None = None,
) -> dict[str, int]:
    """One folder per campaign and kind of CSV with a header, NULL written ``NA``.

    Returns ``rows`` and, for each condition of ``watch``, how many rows meet it. Both are observed while the rows are written: no second scan.

    Overwriting replaces the campaigns and kinds that ``df`` holds; others stay, whatever the session's mode.

    Rows are brought together per campaign by a rebalance, which also cuts a campaign that is
    too big for one file; nothing is squeezed through a single task.
    """
    out, seen = _observed(df, watch)
    out = rename(out, {"sample": rename_sample}) if rename_sample else out
    out = out.withColumns({"upload_campaign": F.col("campaignid"), "upload_kind": F.lit(kind)})
    out = out.hint("rebalance", "upload_campaign")
    if order:
        out = out.sortWithinPartitions("upload_campaign", "upload_kind", *[F.col(c).asc_nulls_last() for c in order])
    writer = out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("upload_campaign", "upload_kind")
    writer.csv(path, header=True, nullValue="NA", quoteAll=quote_all)
    return _figures(seen, watch)


def _observed(df: DataFrame, watch: Mapping[str, Column] | None) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(name) for name, c in (watch or {}).items()]), seen


def _figures(seen: Observation, watch: Mapping[str, Column] | None) -> dict[str, int]:
    try:
        return seen.get
    except Py4JJavaError:  # a plan that is known to be empty is cut away with what would have observed it
        return dict.fromkeys(["rows", *(watch or {})], 0)


def write_upload_files(
    df: DataFrame,
    path: str,
    kind: str,
    rename_sample: str | None = None,
    order: Sequence[str] = (),
    watch: Mapping[str, Column] | None = None,
) -> dict[str, int]:
    """``path/<campaign>_<kind>.csv``, one file for each campaign; returns what ``write_upload`` does.

    Rows are sorted in pieces of about ``ROWS_PER_PIECE``, cut by campaign and order; a file is then its header and its pieces put one after the other by a
    task that holds one line at a time, all campaigns side by side. The files of finished jobs are moved to their names one by one: a task that is tried
    again leaves one file, and a file of the same name is replaced whole.
    """
    spark, (out, seen) = df.sparkSession, _observed(df, watch)
    out = rename(out, {"sample": rename_sample}) if rename_sample else out
    files, staged = Files(spark, path), f"{path.rstrip('/')}/_staged-{uuid.uuid4().hex}"
    out.withColumn("upload_campaign", F.col("campaignid")).write.parquet(f"{staged}/rows")
    figures = _figures(seen, watch)
    rows = spark.read.parquet(f"{staged}/rows")
    by = [F.col("upload_campaign"), *[F.col(c).asc_nulls_last() for c in order]]
    pieces = rows.repartitionByRange(max(1, -(-figures["rows"] // ROWS_PER_PIECE)), *by).sortWithinPartitions(*by)
    pieces.write.partitionBy("upload_campaign").option("maxRecordsPerFile", 0).csv(f"{staged}/pieces", nullValue="NA")
    rows.drop("upload_campaign").limit(0).write.csv(f"{staged}/header", header=True)

    def written(folder: str) -> list[str]:
        """Files of one job in the order of its tasks."""
        return [f"{staged}/{folder}/{n}" for n in files.names(f"{staged}/{folder}") if n.startswith("part-")]

    def put_together(folder: str) -> None:
        # Lines end in a line feed alone, so that cells keep their carriage returns.
        lines = [spark.read.text(literal(p), lineSep="\n").select("value") for p in [*written("header"), *written(f"pieces/{folder}")]]
        reduce(DataFrame.union, lines).coalesce(1).write.text(f"{staged}/whole/{folder}", lineSep="\n")

    folders = [n for n in files.names(f"{staged}/pieces") if n.startswith("upload_campaign=")]
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(put_together, folders))
    for folder in folders:
        campaign = partition_value(folder)
        name = "NA" if campaign == "__HIVE_DEFAULT_PARTITION__" else campaign.replace("/", "%2F")
        part, = written(f"whole/{folder}")
        files.move(part, f"{path.rstrip('/')}/{name}_{kind}.csv")
    files.delete(staged)
    return figures


def store_points(df: DataFrame, path: str) -> None:
    """Ingested dots as Parquet by campaign and kind of export, so that each plan reads only its own.

    The campaigns and kinds in ``df`` are replaced whole, all others stay as they were.
    """
    parts = ["campaignid"] + ["kind"] * ("kind" in df.columns)
    writer = df.hint("rebalance", *parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*parts).parquet(path)


def write_metadata(df: DataFrame, path: str) -> None:
    """The synthesis in both forms: quoted CSV for people, Parquet for the next job."""
    df.write.mode("overwrite").csv(f"{path}/csv", header=True, nullValue="NA", quoteAll=True)
    df.write.mode("overwrite").parquet(f"{path}/parquet")


def write_report(df: DataFrame, path: str) -> None:
    """Any finding as CSV with a header, for instance the classes that no crosswalk knows."""
    df.write.mode("overwrite").csv(path, header=True, nullValue="NA")


def read_plain_csv(spark: SparkSession, path: str, struct: T.StructType) -> DataFrame:
    """A CSV with a header and a known schema, NULL spelled ``NA``."""
    return spark.read.schema(struct).csv(path, header=True, nullValue="NA")
