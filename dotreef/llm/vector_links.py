"""Near-equal vectors by a forest of random-projection trees with spill.

Each tree halves the space again and again at the median of a random direction between two sampled vectors; vectors within
``margin`` of a cut go to both sides. Vectors that share a leaf (and a label) are compared by cosine in double precision, and a pair is counted
in the first leaf it shares only. Leaves send on, per vector, its number of links and its root within the leaf, never pairs;
the roots are the links of a distributed component search. Equal vectors are one class with a count before anything is compared.

The trees are fitted on at most ``sample`` classes (an even draw by hash); every vector is put into leaves. A leaf with more than
``block`` classes is cut into blocks that are compared two by two, so nothing is left out however full it is.

A vector that is NULL, empty, zero, or has NULL or non-finite entries, and one with a NULL label or NULL vec_id, links with nothing. Vectors of
different length never link. Repeated rows are vectors of their own and link with each other. Extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, stored, tune


class Tree:
    """A complete binary tree: node k has the children 2k + 1 and 2k + 2."""

    def __init__(self, sample: np.ndarray, depth: int, rng: np.random.Generator):
        self.depth = depth
        inner = (1 << depth) - 1
        self.direction = np.zeros((inner, sample.shape[1]))
        self.cut = np.zeros(inner)
        members = {0: np.arange(len(sample))}
        for node in range(inner):
            own = members.pop(node, np.empty(0, int))
            d = rng.standard_normal(sample.shape[1])
            if len(own) >= 2:
                a, b = rng.choice(own, 2, replace=False)
                if np.any(sample[a] != sample[b]):
                    d = sample[a] - sample[b]
            self.direction[node] = d / np.linalg.norm(d)
            at = sample[own] @ self.direction[node]
            self.cut[node] = np.median(at) if len(own) else 0.0
            members[2 * node + 1], members[2 * node + 2] = own[at < self.cut[node]], own[at >= self.cut[node]]

    def leaves(self, x: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) pairs; a row within the margin of a cut has several leaves."""
        rows, nodes = np.arange(len(x)), np.zeros(len(x), int)
        for _ in range(self.depth):
            at = np.einsum("ij,ij->i", x[rows], self.direction[nodes]) - self.cut[nodes]
            left, right = at < margin, at >= -margin
            rows, nodes = np.concatenate([rows[left], rows[right]]), np.concatenate([2 * nodes[left] + 1, 2 * nodes[right] + 2])
        return rows, nodes - ((1 << self.depth) - 1)


def unit(rows) -> np.ndarray:
    x = np.array(list(rows), float)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _compare(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links and root of every class of one leaf, or of two of its blocks, that is linked there first."""
    x, low = unit(pdf["embedding"]), (pdf["b"] == pdf["low"]).to_numpy()
    across = pdf["low"].iat[0] != pdf["high"].iat[0]
    linked = x @ x.T >= threshold
    np.fill_diagonal(linked, False)
    if across:
        linked &= low[:, None] != low[None, :]
    if linked.any():
        own = pdf["leaf"].iat[0]
        names: dict[int, int] = {}
        r, c = [], []
        for i, leaves in enumerate(pdf["leaves"]):
            for leaf in leaves:
                if leaf < own:
                    r.append(i)
                    c.append(names.setdefault(int(leaf), len(names)))
        if names:
            before = np.zeros((len(pdf), len(names)), np.float32)
            before[r, c] = 1
            linked &= before @ before.T == 0
    some = linked.any(axis=1)
    root = np.arange(len(pdf))
    while True:
        least = np.minimum(root, np.where(linked, root[None, :], len(pdf)).min(axis=1, initial=len(pdf)))
        least = least[least]
        if (least == root).all():
            break
        root = least
    cid, n = pdf["cid"].to_numpy(), pdf["n"].to_numpy()
    return pd.DataFrame({"a": cid[some], "b": cid[root][some], "links": (linked @ n)[some]})


def link(vectors: DataFrame, threshold: float = 0.93, trees: int = 6, margin: float = 0.02, leaf: int = 256, block: int = 1024,
         sample: int = 20_000, seed: int = 7) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors (vec_id, embedding, label)``."""
    tune(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    odd = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    some = F.exists("embedding", lambda v: v != 0)
    good = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & ~odd & some, F.lit(False))
    classes = rows.where(good).groupBy("label", "embedding").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("n"))
    classes = stored(classes.withColumns({"dim": F.size("embedding"), "cid": F.monotonically_increasing_id()}), "classes")

    total = classes.count()
    largest = classes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    share = min(1.0, sample / max(1, total))
    drawn = classes.where(F.pmod(F.xxhash64("cid"), F.lit(1 << 30)) < int(share * (1 << 30))).select("dim", "embedding").limit(2 * sample)
    depth = max(0, min(math.ceil(math.log2(max(1, largest) / leaf)), int(math.log2(sample / 4))))
    fitted = drawn.toPandas()  # at most 2 * ``sample`` rows
    forest = {
        int(dim): [Tree(unit(own["embedding"]), depth, np.random.default_rng([seed, t])) for t in range(trees)]
        for dim, own in fitted.groupby("dim")
    }

    def plant(batches):
        for pdf in batches:
            found: list[list[int]] = [[] for _ in range(len(pdf))]
            for dim, own in pdf.reset_index(drop=True).groupby("dim"):
                x = unit(own["embedding"])
                for t, tree in enumerate(forest.get(dim, ())):
                    for i, n in zip(*tree.leaves(x, margin), strict=True):
                        found[own.index[i]].append(t << 32 | int(n))
            pdf["leaves"] = [sorted(f) or [-1] for f in found]  # a length that the sample lacks is one leaf
            yield pdf

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    planted = stored(classes.mapInPandas(plant, f"{kinds}, leaves array<long>"), "leaves")
    where = ["label", "dim", "leaf"]
    placed = planted.select("cid", "n", "embedding", "leaves", "label", "dim", F.explode("leaves").alias("leaf"))
    sizes = planted.select("label", "dim", F.explode("leaves").alias("leaf")).groupBy(*where).count().where("count > 1")
    sizes = sizes.select(*where, F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    cut = placed.join(sizes, where).withColumn("b", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.withColumns({"low": F.least("b", "other"), "high": F.greatest("b", "other")}).drop("other", "blocks")
    found = cut.groupBy(*where, "low", "high").applyInPandas(lambda pdf: _compare(pdf, threshold), "a long, b long, links long")
    found = stored(found, "links")

    links = found.groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("links"))
    parts = components(found.select("a", "b")).withColumnRenamed("node", "cid")
    known = classes.select("cid", "vec_id", "n", "label", "embedding").join(links, "cid", "left").join(parts, "cid", "left")
    known = stored(known.withColumn("component", F.coalesce("component", "cid")), "known")
    names = stored(known.groupBy("component").agg(F.min("vec_id").alias("component_id")), "names")
    known = known.join(names, "component").select(
        "label", "embedding", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")
    )
    linked = rows.where(good).join(known, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
