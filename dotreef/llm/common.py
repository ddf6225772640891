"""What the operators share: shared storage, stable row locators, per-document maps and components of a link table."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import scratch_dir

#: Settings under which a task keeps few texts in memory at once, hot join keys are cut at run time, and shuffle files
#: go when the action that wrote them is over.
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Results are lazy and run later, so these stay set for the session; whatever is needed only inside an operator goes through ``settings``."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    # Workers find this package also where the driver was started elsewhere.
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    return spark


def give_back() -> None:
    """What a worker has freed goes back to the system: workers outlive their tasks, and the allocators keep for later use what large batches took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """The session with ``values`` set, and as it was before afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def stored(df: DataFrame, name: str = "part", path: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends here, and a lost executor costs no recomputation before it.

    The table goes with the process (``scratch_dir``), or earlier if the caller drops it.
    """
    path = path or scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` alone; other columns stay behind, a NULL text is empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


#: Stands for a NULL doc_id inside pandas, which would turn a column of long numbers with gaps into doubles.
NO_ID = -(1 << 63)


def with_id(df: DataFrame) -> DataFrame:
    return df.withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))


def without_id(df: DataFrame) -> DataFrame:
    return df.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))


def located(docs: DataFrame) -> DataFrame:
    """Every column of ``docs`` and last the place of the row: hash of its file and row number there, under a name that is free (``place_of``).

    Rows that come from no file (or through an operator that hides it) are first stored once in the shared folder.
    """
    name, taken = "_place_of_row", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"

    def placed(df: DataFrame) -> DataFrame:
        hidden = df.metadataColumn("_metadata")  # a column of that name may stand beside it
        return df.select("*", F.struct(F.xxhash64(hidden["file_path"]).alias("file"), hidden["row_index"].cast("long").alias("row")).alias(name))

    try:
        return placed(docs)
    except AnalysisException:
        return placed(stored(docs, "rows"))


def place_of(rows: DataFrame) -> str:
    """Name of the column that ``located`` added."""
    return rows.columns[-1]


def per_document(df: DataFrame, fn: Callable[[list[str]], dict[str, Sequence]], schema: str, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keys`` and the columns that ``fn`` makes of a list of whole texts, batch by batch."""
    names = [*keys, *[c.split()[0] for c in schema.split(", ")]]
    out = ", ".join([*[f"{k} {df.schema[k].dataType.simpleString()}" for k in keys], schema])
    arrow = pa.schema([pa.field(n, _arrow(t)) for n, t in (c.split() for c in schema.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = fn(b.column(len(keys)).to_pylist())
            made = [pa.array(cols[f.name], type=f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keys)], *made], names=names)

    return df.select(*keys, "text").mapInArrow(run, out)


def _arrow(kind: str) -> pa.DataType:
    plain = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.list_(_arrow(kind[6:-1])) if kind.startswith("array<") else plain[kind]


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """``(node, component)`` of the undirected ``links (a, b)``; the component is its smallest node. Nodes without a link are absent.

    Alternating large-star and small-star rounds: each replaces the links by as many or fewer and ends in stars. A hub folds
    map-side into one minimum, its links are cut by the skew join. Every round is a table in the shared folder.
    """
    now = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    before = _print(now)
    while before[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u <> v").distinct(), name)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = large.join(low, "u")
        small = pairs.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(low.select("u", F.col("m").alias("v")))
        now = stored(small.distinct(), name)
        after = _print(now)
        if after == before:
            break
        before = after
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _print(df: DataFrame) -> tuple:
    row = df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").bitwiseAND(F.lit((1 << 40) - 1)))).first()
    return tuple(row)
