"""Exact duplicates by a stateful stream with disk-backed keyed state, in DataFrame operations only.

A landing table of (digest, doc_id, place of the row) feeds a structured stream. Its state lives in RocksDB without expiry: per digest the
largest doc_id (the stable identifier), the place of that row (the content locator) and a count. Rows fold map-side before
they reach the state, so a digest that holds a third of all rows is one row per task. Rows whose digest came more than once
are then compared byte for byte with the text at the locator; digests under which texts differ are grouped anew by the text itself.

NULL text is the empty text. A NULL doc_id is smaller than any other. Rows that agree in everything are still rows: one stays. Extra
columns are not read. Empty input gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import scratch_dir
from .common import located, place_of, settings, stored, tune

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FILES_PER_BATCH = 64
#: While the stream runs: disk-backed state, and a store is open while its task runs, not longer.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKS,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def seen(landing: DataFrame) -> DataFrame:
    """State of the stream over a stored ``landing`` table: ``digest, keep (doc_id, loc), n``."""
    spark = landing.sparkSession
    if landing.isEmpty():
        return landing.groupBy("digest").agg(F.max(F.struct("doc_id", "loc")).alias("keep"), F.count("*").alias("n"))
    checkpoint = scratch_dir(spark, "dedup-state")
    folder = landing.inputFiles()[0].rsplit("/", 1)[0]
    rows = spark.readStream.schema(landing.schema).option("maxFilesPerTrigger", FILES_PER_BATCH).parquet(folder)
    state = rows.groupBy("digest").agg(F.max(F.struct("doc_id", "loc")).alias("keep"), F.count("*").alias("n"))
    sink = state.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    with settings(spark, STATE):
        sink.start().awaitTermination()
    held = spark.read.format("statestore").load(checkpoint)
    keep, n = held.schema["value"].dataType.names
    return held.select(F.col("key.digest").alias("digest"), F.col(f"value.`{keep}`").alias("keep"), F.col(f"value.`{n}`").alias("n"))


def assign(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256, loc`` for every row of ``docs``."""
    return _assign(located(docs), digest)


def _assign(placed: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    tune(placed.sparkSession)
    rows = placed.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{place_of(placed)}`").alias("loc"), _text().alias("text"))
    landing = stored(rows.select("doc_id", "loc", digest(F.col("text")).alias("digest"), sha256(F.col("text")).alias("sha")), "landing")
    state = stored(seen(landing), "state")
    out = landing.join(state, "digest").select(
        "digest", "doc_id", "loc", F.col("keep.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("loc") == F.col("keep.loc")).alias("kept"), "sha",
    )
    hits = out.where("group_size > 1").select("digest", "loc", F.col("kept").alias("keeper"))
    held = stored(rows.select("loc", "text").join(hits, "loc"), "hits")
    keeper = held.where("keeper").select("digest", F.col("text").alias("keeper_text"))
    differ = stored(held.where("NOT keeper").join(keeper, "digest").where("text <> keeper_text").select("digest").distinct(), "collisions")
    if not differ.isEmpty():
        apart = landing.join(held.join(differ, "digest", "left_semi").select("loc", "text"), "loc")
        groups = apart.groupBy("digest", "text").agg(F.max(F.struct("doc_id", "loc")).alias("keep"), F.count("*").alias("group_size"))
        anew = apart.join(groups, ["digest", "text"]).select(
            "digest", "doc_id", "loc", F.col("keep.doc_id").alias("keep_id"), "group_size", (F.col("loc") == F.col("keep.loc")).alias("kept"), "sha"
        )
        out = out.join(differ, "digest", "left_anti").unionByName(anew)
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"), "loc")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: one of each group of equal texts."""
    rows = located(docs)
    kept = _assign(rows, sha256).where("kept").select(F.col("loc").alias(place_of(rows)))
    return rows.join(kept, place_of(rows), "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
