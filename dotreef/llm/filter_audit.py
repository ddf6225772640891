"""How filters overlap, for every order in which they can run: min-plus removal ranks.

A document is the set of filters that it fails, a row of a mask matrix. An order of the filters is a permutation; its inverse gives
each filter's position. The step at which an order removes a document is the minimum, over the filters that it fails, of their positions:
the min-plus product of the mask matrix (0 where a filter fails, infinity elsewhere) with the position matrix. Documents are counted by part and
mask once; every figure of every order is then a scatter of these counts by removal step.

Spark does the work that grows: one projection works out the masks, identical texts are found by aggregations that fold before each exchange (a
text that holds a third of all rows is a few rows per task), and what is left is at most 2 ** filters rows per part. The product runs per part on
these.

NULL text, and NULL lang as the part, are empty. A text is a duplicate where a row with a smaller doc_id has the same text; rows that agree in
doc_id and text are no duplicates of each other, and a row without a doc_id neither is one nor makes one. A document has a label if any row of
``labels`` with its doc_id has it. An empty text fails the word count only. No document, no part, no row. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import tune

#: Failure conditions over ``text``, ``words`` (array) and ``n_words``. Limits and characters of the filters.
FILTERS: Mapping[str, str] = {
    "A": "n_words < 100",
    "B": "100 * size(array_distinct(words)) < 80 * n_words",
    "C": "100 * (length(text) - length(regexp_replace(text, '[A-Z]+', ''))) > 10 * length(text)",
    "D": "text RLIKE '[#$%&*|]'",
}
DUPLICATE = "E"
WORD_BREAK = r"[\x20\x09-\x0D]+"
LABELS = ("good", "toxic")

RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, "
    "toxic_lost long, shapley long"
)


def masks(docs: DataFrame, filters: Mapping[str, str] = FILTERS) -> DataFrame:
    """``doc_id, part, digest, mask`` of every row; bit i of the mask says that it fails the i-th of ``filters``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text)
    rows = rows.withColumn("words", F.array_remove(F.split("text", WORD_BREAK), "")).withColumn("n_words", F.size("words").cast("long"))
    bits: Iterable[Column] = [F.when(F.expr(c), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(filters.values())]
    mask = sum(bits, F.lit(0)).cast("int")
    return rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask"))


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    flags = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in LABELS]
    return rows.join(known, "doc_id", "left").select(*rows.columns, *flags)


def mask_counts(docs: DataFrame, labels: DataFrame, filters: Mapping[str, str] = FILTERS) -> DataFrame:
    """``part, mask, n, good, toxic``: documents, good and toxic ones by part and mask. The bit after ``filters`` marks duplicates.

    No row is looked up to learn whether it is a duplicate: per text, all rows are, but those that have its smallest doc_id and those without one.
    """
    same = ["digest", "part", "mask", *LABELS]
    rows = _labelled(masks(docs, filters), labels)
    once = rows.groupBy(*same, "doc_id").agg(F.count("*").alias("n"))
    low = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("low")
    nameless = F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("nameless")
    texts = once.groupBy(*same).agg(F.sum("n").alias("n"), low, nameless)
    least = F.min("low.doc_id").over(W.partitionBy("digest"))
    first = F.when(F.col("low.doc_id") == F.col("least"), F.col("low.n")).otherwise(F.lit(0)) + F.col("nameless")
    split = texts.withColumn("least", least).withColumn("first", first)
    marked = F.col("mask") + F.lit(1 << len(filters))
    either = F.array(F.struct(F.col("mask"), F.col("first").alias("n")), F.struct(marked.alias("mask"), (F.col("n") - F.col("first")).alias("n")))
    parts = split.select("part", *LABELS, F.inline(either)).where("n > 0")
    return parts.groupBy("part", "mask").agg(F.sum("n").alias("n"), *[F.sum(F.col("n") * F.col(c)).alias(c) for c in LABELS])


def removal_steps(n_filters: int, orders: np.ndarray) -> np.ndarray:
    """Steps (from 1; n_filters + 1 if never) at which each order, a column, removes each mask, a row: a min-plus product."""
    failing = (np.arange(1 << n_filters)[:, None] >> np.arange(n_filters)) & 1
    free = n_filters + 1
    cost = np.where(failing == 1, 0, free)  # mask by filter
    position = np.empty_like(orders)  # order by filter: the inverse permutation
    np.put_along_axis(position, orders, np.arange(1, n_filters + 1)[None, :], axis=1)
    return np.minimum((cost[:, None, :] + position[None, :, :]).min(axis=2), free)


def figures(counts: np.ndarray, steps: np.ndarray, orders: np.ndarray) -> dict[str, np.ndarray]:
    """Every figure by order and step, for the rows n, good and toxic of ``counts`` by mask."""
    n_orders, k = orders.shape
    failing = ((np.arange(1 << k)[:, None] >> np.arange(k)) & 1).astype(np.int64)
    removed = np.zeros((3, n_orders, k + 2), np.int64)
    at = np.arange(n_orders)[None, :].repeat(len(steps), 0)
    for row, weight in zip(removed, counts, strict=True):
        np.add.at(row, (at, steps), weight[:, None])
    gone = removed[:, :, 1 : k + 1]
    failed = (counts[0] @ failing)[orders]  # all that fail the filter of each step
    alone = counts[0][1 << np.arange(k)][orders]
    shapley = np.zeros(k, np.int64)
    np.add.at(shapley, orders, gone[0])
    return {
        "kept": counts[0].sum() - gone[0].cumsum(axis=1), "removed": gone[0], "redundant": failed - gone[0], "unique_fails": alone,
        "good_lost": gone[1], "toxic_lost": gone[2], "shapley": shapley[orders],
    }


def audit(docs: DataFrame, labels: DataFrame, filters: Mapping[str, str] = FILTERS, duplicate: str = DUPLICATE) -> DataFrame:
    """One row per part, order of ``filters`` and ``duplicate``, and step."""
    tune(docs.sparkSession)
    return ranked(mask_counts(docs, labels, filters), [*filters, duplicate])


def ranked(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """``RESULT`` of ``mask_counts``; a group is at most 2 ** filters rows."""
    names, k = list(names), len(names)
    orders = np.array(list(permutations(range(k))), dtype=np.int64)
    steps = removal_steps(k, orders)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        table = np.zeros((3, 1 << k), np.int64)
        table[:, pdf["mask"].to_numpy()] = pdf[["n", *LABELS]].to_numpy(np.int64).T
        made = {c: v.ravel() for c, v in figures(table, steps, orders).items()}
        spelled = np.repeat(["".join(names[i] for i in o) for o in orders], k)
        return pd.DataFrame({"part": pdf["part"].iloc[0], "filter_order": spelled, "step": np.tile(np.arange(1, k + 1, dtype=np.int32), len(orders)), **made})

    return counts.groupBy("part").applyInPandas(run, RESULT)
