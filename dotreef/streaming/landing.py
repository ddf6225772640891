"""The landing folder as a stream of changes.

A scan lists the folder (names, lengths and times; no file is opened) and compares it with a ledger of what has been counted. New, late, changed and
withdrawn files become rows of a feed, which only ever grows; the stream reads the feed, so no age limit of a file source can lose an export,
whatever its time says. A batch reads its own files, counts their dots, and subtracts what the earlier version of a changed or withdrawn
file had added: that version's dots are in the batch folder that the ledger names. Counts and ledger are published together (``levels``).

Two versions of a file that agree in length and time are not told apart by a listing; ``recount`` reads every file again.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from inspect import signature

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.nulls import in_set
from ..operators.columns import path_columns, union_by_name
from ..sources.files import Files, literal, partition_value, plain_path
from ..sources.ragged import PATH, read_annotations, scan_ragged
from .levels import Levels, latest, sums

FILES_PER_BATCH = 500
_EVENT = "path string, length long, time timestamp, gone boolean"
#: Feed files are read however long a stream has rested.
_NEVER = "36500d"

Reader = Callable[[SparkSession, list[str], Sequence[str]], DataFrame]


def annotations(spark: SparkSession, paths: list[str], columns: Sequence[str], of_path: Sequence[Column] = ()) -> DataFrame:
    return read_annotations(spark, paths, columns=columns, glob=None, of_path=of_path)


def deployments(spark: SparkSession, paths: list[str], columns: Sequence[str], of_path: Sequence[Column] = ()) -> DataFrame:
    """Sample metadata: comma separated, a header and no lines before it."""
    return scan_ragged(spark, paths, sep=",", skip=0, columns=columns, na=("", "NA"), trim=True, of_path=of_path)


@dataclass
class Landing:
    """One kind of file of a landing folder, counted as it changes.

    ``count`` maps rows to a table with ``campaignid``, class columns and ``total``, the number that adds up over files. ``store`` takes the rows by batch;
    the feed and the published state lie beside it. ``read`` turns paths into rows with ``columns`` and ``__path``; one that takes ``of_path`` is given what
    follows from a file's path, to work it out once per file.
    """

    spark: SparkSession
    landing: str
    store: str
    count: Callable[[DataFrame], DataFrame]
    columns: Sequence[str]
    folders: Sequence[str] = ("project", "campaignid")
    glob: str = "*_Dot Point Measurements.txt"
    files_per_batch: int = FILES_PER_BATCH
    total: str = "count"
    read: Reader = annotations
    out: str | None = None
    levels: Levels = field(init=False)

    def __post_init__(self) -> None:
        self.store = self.store.rstrip("/")
        self.levels = Levels(self.spark, f"{self.store}-state", {"counts": sums(self.total), "ledger": latest("path", "as_of")})

    # --- what is published ---------------------------------------------------------------

    def counts(self, number: int | None = None) -> DataFrame | None:
        """The counts of the last published state (or of an earlier one that is still there)."""
        return self.levels.read("counts", number)

    def ledger(self) -> DataFrame | None:
        """One row per path ever seen: length, time, rows and digest of the version counted, its batch, and whether it is gone."""
        return self.levels.read("ledger")

    def rows(self) -> DataFrame | None:
        """The rows of all files as they are now, from the batch folders."""
        ledger, struct = self.ledger(), self.levels.schema("rows")
        if ledger is None or struct is None:
            return None
        stored = self._stored(self.store, T.StructType([*struct.fields, T.StructField("batch", T.LongType())]))
        current = ledger.filter("NOT gone").select(F.col("path").alias(PATH), F.col("as_of").alias("batch"))
        return stored.join(current, [PATH, "batch"], "left_semi").drop("batch")

    # --- scan ----------------------------------------------------------------------------

    def scan(self, recount: bool = False) -> int:
        """Writes what has changed since the last batch to the feed; returns how many files that are."""
        listed = (
            self.spark.read.format("binaryFile").option("pathGlobFilter", self.glob).option("recursiveFileLookup", "true").load(self.landing)
            .select(plain_path(F.col("path"), False).alias("path"), "length", F.col("modificationTime").alias("time"))
        )
        ledger = self.ledger()
        if ledger is None:
            events = listed.withColumn("gone", F.lit(False))
        else:
            known = ledger.select("path", F.col("length").alias("old_length"), F.col("time").alias("old_time"), F.col("gone").alias("old_gone"))
            both = listed.join(known, "path", "full")
            gone = F.col("length").isNull()
            same = F.col("length").eqNullSafe(F.col("old_length")) & F.col("time").eqNullSafe(F.col("old_time")) & ~F.coalesce("old_gone", F.lit(False))
            wanted = F.when(gone, ~F.col("old_gone")).otherwise(F.lit(recount) | ~same)
            events = both.filter(wanted).select("path", "length", "time", gone.alias("gone"))
        feed = f"{self.store}-feed"
        draft = f"{self.store}-scans/{time.time_ns():020d}-{uuid.uuid4().hex}"
        events.write.parquet(draft)
        events = self.spark.read.schema(_EVENT).parquet(draft)
        n = events.count()
        if n:
            # A feed file is a batch; a path stands in one file only.
            events.repartition(-(-n // self.files_per_batch)).write.parquet(f"{feed}/{draft.rsplit('/', 1)[1]}")
        Files(self.spark, draft).delete(draft)
        return n

    # --- batches -------------------------------------------------------------------------

    def start(self, checkpoint: str) -> StreamingQuery:
        """Processes what the feed holds, then stops."""
        feed = f"{self.store}-feed"
        Files(self.spark, feed).make(feed)
        events = (
            self.spark.readStream.schema(_EVENT).option("maxFilesPerTrigger", 1).option("maxFileAge", _NEVER)
            .option("recursiveFileLookup", "true").parquet(feed)
        )
        return events.writeStream.foreachBatch(self._on_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def _on_batch(self, batch: DataFrame, batch_id: int) -> None:
        state = self.levels.state()
        if state.batch < batch_id:
            self._process(batch, batch_id)
            state = self.levels.state()
        if state.batch == batch_id and self.out:
            self._export(state.note)

    def _process(self, batch: DataFrame, batch_id: int) -> None:
        # Names only, and no more of them than files_per_batch; contents are read by the tasks.
        rows = batch.collect()
        batch = self.spark.createDataFrame(rows, _EVENT)
        events = {r["path"]: r for r in rows}
        files = Files(self.spark, self.landing)
        there = [p for p, r in events.items() if not r["gone"] and files.exists(p)]
        ledger = self.ledger()
        known = []
        if ledger is not None:
            known = ledger.filter("NOT gone").join(batch.select("path"), "path", "left_semi").select("path", "as_of").collect()
        own, struct = f"{self.store}/batch={batch_id}", self.levels.schema("rows")
        parts = []
        if there:
            of_path = [*path_columns(F.col(PATH), self.landing, self.folders), plain_path(F.col(PATH), True).alias("__plain")]
            once = "of_path" in signature(self.read).parameters
            raw = self.read(self.spark, [literal(p) for p in there], self.columns, **{"of_path": of_path} if once else {})
            placed = raw if once else raw.select(*self.columns, *of_path)
            placed = placed.select(*self.columns, *self.folders, F.col("__plain").alias(PATH))
            placed.write.mode("overwrite").partitionBy("campaignid").parquet(own)
            struct = placed.schema
            new = self._stored(own, struct)
            parts.append(self.count(new))
        for folder in {r["as_of"] for r in known}:
            # The folder of an earlier batch is read only when one of its files is replaced.
            before = [r["path"] for r in known if r["as_of"] == folder]
            old = self._stored(f"{self.store}/batch={folder}", struct).filter(in_set(PATH, before))
            counted = self.count(old)
            parts.append(counted.withColumn(self.total, -F.col(self.total)))
        entries = batch.select("path", "length", "time", (F.col("gone") | ~in_set("path", there)).alias("gone"))
        if there:
            digest = F.sum(F.xxhash64(*self.columns).cast("decimal(38,0)")).cast("string").alias("digest")
            per_file = new.groupBy(F.col(PATH).alias("path")).agg(F.count(F.lit(1)).alias("rows"), digest)
            entries = entries.join(per_file, "path", "left")
        else:
            entries = entries.withColumns({"rows": F.lit(None).cast("long"), "digest": F.lit(None).cast("string")})
        entries = entries.select("path", "length", "time", F.coalesce("rows", F.lit(0)).alias("rows"), "digest", "gone", F.lit(batch_id).cast("long").alias("as_of"))
        made = {"ledger": entries}
        touched = []
        if parts:
            delta = sums(self.total)(union_by_name(*parts)).persist()
            touched = sorted({r["campaignid"] for r in delta.select("campaignid").distinct().collect()}, key=str)  # at most as many as the batch has files
            made["counts"] = delta
        self.levels.commit(batch_id, made, note=touched, also={"rows": struct} if struct else {})
        if parts:
            delta.unpersist()

    def _stored(self, folder: str, struct: T.StructType) -> DataFrame:
        # With the schema given, campaign names that look like numbers stay names.
        return self.spark.read.schema(struct).parquet(folder)

    def _export(self, touched: list[str]) -> None:
        """The summed counts of the touched campaigns as partitions of ``out``, for readers of plain Parquet. A campaign with nothing left goes."""
        counts = self.counts()
        if counts is None or not touched:
            return
        mine = counts.filter(in_set("campaignid", touched)).persist()
        mine.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("campaignid").parquet(self.out)
        left = {r["campaignid"] for r in mine.select("campaignid").distinct().collect()}
        mine.unpersist()
        files = Files(self.spark, self.out)
        for name in files.names(self.out):
            if name.startswith("campaignid=") and partition_value(name) in set(touched) - left:
                files.delete(f"{self.out}/{name}")


def refresh_counts(
    spark: SparkSession,
    landing: str,
    store: str,
    out: str,
    count: Callable[[DataFrame], DataFrame],
    *,
    checkpoint: str,
    columns: Sequence[str],
    recount: bool = False,
    **options,
) -> StreamingQuery:
    """Scans the landing folder and starts the stream: everything that changed is processed, then it stops.

    ``out`` gets the sums by campaign partition. A campaign is overwritten there while readers may look; ``Landing.counts`` shows published states only.
    """
    box = Landing(spark, landing, store, count, columns, out=out, **options)
    box.scan(recount)
    return box.start(checkpoint)
