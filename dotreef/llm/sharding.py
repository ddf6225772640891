"""Consistent-hash ring with virtual nodes and bounded loads.

A document's hash falls on an arc that ends at a virtual node of some shard. Arcs are counted first (as many numbers as there are virtual
nodes). Each shard takes the documents of its own arcs up to its bound; the rest of an arc continues clockwise to the next
virtual nodes whose shards have room. With no slack the bounds add up to the number of documents and the counts of
shards differ by one at most. A document's place in its arc, by hash, says which part of the arc it belongs to.

NULL text has no bytes. A NULL doc_id hashes by its text alone. Equal texts are placed by their own doc_ids. Rows alike
in doc_id and text are interchangeable. Extra columns are not read. No documents, no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts, tune, with_id, without_id


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixer (splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ring(shards: int, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Points of the virtual nodes in ring order, and the shard of each. More shards only add points."""
    owner = np.repeat(np.arange(shards), nodes)
    points = _mix(_mix(owner.astype("uint64") << np.uint64(20) | np.tile(np.arange(nodes), shards).astype("uint64"))).view("int64")
    order = np.argsort(points, kind="stable")
    return points[order], owner[order]


def bounds(total: int, shards: int, slack: float) -> list[int]:
    """The most documents each shard takes; without slack their sum is the number of documents."""
    if slack > 0:
        return [math.ceil((1 + slack) * total / shards)] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def parts(counts: dict[int, int], owner: np.ndarray, most: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first place, place after the last, shard, first slot) of every part of every arc."""
    load, out, queue = [0] * len(most), [], []

    def give(arc: int, at: int, n: int, shard: int) -> None:
        out.append((arc, at, at + n, shard, load[shard]))
        load[shard] += n

    rest = {}
    for arc, shard in enumerate(owner.tolist()):
        n = counts.get(arc, 0)
        home = min(n, most[shard] - load[shard])
        if home:
            give(arc, 0, home, shard)
        if n > home:
            rest[arc] = home
    for _ in range(2):
        for arc, shard in enumerate(owner.tolist()):
            while queue and load[shard] < most[shard]:
                came, at = queue[0]
                n = min(counts[came] - at, most[shard] - load[shard])
                give(came, at, n, shard)
                queue[0] = (came, at + n)
                if at + n == counts[came]:
                    queue.pop(0)
            if arc in rest:
                queue.append((arc, rest.pop(arc)))
    return out


def assign(docs: DataFrame, shards: int = 40, nodes: int = 64, slack: float = 0.0) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every document; slots of a shard count from 0 without gaps."""
    spark = tune(docs.sparkSession)
    points, owner = ring(shards, nodes)

    def arcs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["arc"] = np.searchsorted(points, pdf["point"].to_numpy(), side="left") % len(points)
            yield pdf

    rows = texts(docs).select(
        "doc_id",
        (F.octet_length("text").cast("long") + 16).alias("size"),
        F.crc32("text").alias("text_crc32"),
    )
    rows = rows.withColumn("point", F.when(F.col("doc_id").isNull(), F.xxhash64("text_crc32", "size")).otherwise(F.xxhash64("doc_id")))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    placed = with_id(rows).mapInPandas(arcs, f"{kinds}, arc int")
    counted = {r["arc"]: r["count"] for r in placed.groupBy("arc").count().collect()}  # one number for each virtual node
    table = parts(counted, owner, bounds(sum(counted.values()), shards, slack))
    segments = spark.createDataFrame(table, "arc int, low long, high long, shard int, first long")
    numbered = placed.selectExpr(
        "*", "row_number() OVER (PARTITION BY arc ORDER BY point, doc_id, text_crc32, size) - 1L AS place"
    )
    joined = numbered.join(segments, "arc").where("place >= low AND place < high")
    return without_id(joined).select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("place") - F.col("low")).alias("slot"))
