"""Documents to packed training sequences: toxicity, exact dedup, near dedup, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dotreef.llm import exact_dedup, near_dedup, packing, pii, toxicity
from dotreef.llm.common import documents, stored
from dotreef.sources.sinks import drop_scratch, scratch_count, scratch_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5 stay; the model is learned from the labelled rows that are not held out."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.clean_rows(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates the row with the smallest doc_id stays."""
    return near_dedup.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; personal data becomes its kind in angle brackets, and ``n_chars`` counts what is there now."""
    masked = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in sequences of 2048 ids."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

#: A learned filter and a tokenizer have no SQL form; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, first = documents(spark, sf_dir), scratch_count()
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, name)
        docs = stored(stage(spark, docs, sf_dir), path=path)
        drop_scratch(spark, first, keep=[path])  # what the stage worked with, and the table it read
    return STAGES[-1][1](spark, docs, sf_dir)
