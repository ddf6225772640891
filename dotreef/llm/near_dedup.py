"""Near duplicates by BagMinHash over multisets of five-word shingles.

A shingle of weight w is a Poisson process on [0, w), discretised at whole numbers and built from the dyadic pieces [0, 1), [1, 2), [2, 4), ... A piece's
process depends on the shingle and the piece alone; where w ends inside a piece, its points split further by their place and
those beyond w are left out. Each point has a time and a register, and a register keeps the earliest time: two documents agree
in a register with the probability of their weighted Jaccard similarity. A process ends once its time passes the latest register of its document.

Signatures are banded; documents that share a band are compared by the exact overlap of their shingle multisets. Equal multisets are one
class first. Every bucket names a hub, and the members of all buckets with one hub are compared together: all with the hub, then
those that it does not join with everyone, by lists of the members that have a shingle. Tasks send on the links that join
components, never pairs. Many members of one hub are cut into blocks that meet two by two, so no link is lost to a cap.

Words are runs of letters and digits, lower-cased; a text of fewer than five words is one shingle. A NULL, empty or wordless text is
alone in its class. Repeated rows are rows of one class, of which the one with the smallest doc_id (NULL first, then by place) stays. Extra
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, located, place_of, stored, tune, with_id, without_id

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 26, 5
#: Members of a hub that one block holds.
BLOCK = 400

_SEPARATE = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _odd(constant: int, n: int) -> np.uint64:
    return _U(constant * n & (1 << 64) - 1)


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes in order, and how often each occurs."""
    found = text.lower().encode().translate(_SEPARATE).split()
    if not found:
        return np.empty(0, _U), np.empty(0, np.int64)
    known: dict[bytes, int] = {}
    hashed = np.fromiter([known.get(w) or known.setdefault(w, xxhash.xxh3_64_intdigest(w)) for w in found], _U, len(found))
    n = min(SHINGLE, len(found))
    h = np.full(len(found) - n + 1, n, _U)
    for i in range(n):
        h = mix(h * _U(0x9E3779B97F4A7C15) + hashed[i : len(found) - n + 1 + i])
    return np.unique(h, return_counts=True)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    return both / max(1, a[1].sum() + b[1].sum() - both)


def signatures(bags: Sequence[tuple[np.ndarray, np.ndarray]], registers: int) -> np.ndarray:
    """Register times of each bag, infinite for an empty one."""
    times = np.full((len(bags), registers), np.inf)
    if not any(len(b[0]) for b in bags):
        return times
    doc = np.repeat(np.arange(len(bags)), [len(b[0]) for b in bags])
    shingle, weight = np.concatenate([b[0] for b in bags]), np.concatenate([b[1] for b in bags])
    parts, low = [], 0
    while len(doc):  # the pieces [0, 1), [1, 2), [2, 4), ... that begin below the weight
        parts.append((doc, mix(shingle + _odd(0x632BE59BD9B4E019, low + 1)), np.full(len(doc), max(1, low)), weight - low))
        low = max(1, 2 * low)
        on = weight > low
        doc, shingle, weight = doc[on], shingle[on], weight[on]
    doc, seed, size, inside = (np.concatenate(p) for p in zip(*parts, strict=True))
    at, flat = np.zeros(len(doc)), times.reshape(-1)
    turn = 0
    while len(doc):
        turn += 1
        draw = mix(seed + _odd(0x9E3779B97F4A7C15, turn))
        at = at - np.log(((draw >> _U(11)).astype(float) + 0.5) * 2.0**-53) / size
        on = at < times.max(axis=1)[doc]
        doc, seed, size, inside, at, draw = doc[on], seed[on], size[on], inside[on], at[on], draw[on]
        place = mix(draw ^ _U(0xD1B54A32D192ED03))
        hit = (place >> _U(32)).astype(np.int64) % size < inside
        register = (place & _U(0xFFFFFFFF)).astype(np.int64) % registers
        np.minimum.at(flat, doc[hit] * registers + register[hit], at[hit])
    return times


def bands(times: np.ndarray, rows: int) -> np.ndarray:
    """One number for each band of ``rows`` registers."""
    bits = times.view(_U).reshape(len(times), -1, rows)
    h = np.zeros(bits.shape[:2], _U)
    for i in range(rows):
        h = mix(h * _U(0x9E3779B97F4A7C15) + bits[:, :, i])
    return h.view(np.int64)


def _sign(n_bands: int, rows: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 250):
                part = pdf.iloc[at : at + 250]
                bags = [bag(t) for t in part["text"]]
                keys = bands(signatures(bags, n_bands * rows), rows)
                digest = [hashlib.md5(h.tobytes() + c.tobytes()).digest() if len(h) else None for h, c in bags]
                found = [k if len(b[0]) else None for k, b in zip(keys, bags, strict=True)]
                yield part[["doc_id", "file", "row"]].assign(digest=digest, bands=found)

    return run


def _tokens(own: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The bag as a set: the first, second, ... occurrence of a shingle are different tokens, so shared tokens are the overlap."""
    h, n = own
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(h, n) ^ mix(nth.astype(_U))


def _link(pdf: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """Links that join the members of one hub (or of two blocks of them) into the components they form.

    Everyone is compared with the hub; then each member outside the hub's component with all others, through the lists of members that have
    a token. Pairs inside one component need no look.
    """
    pdf = pdf.drop_duplicates("cid", ignore_index=True)
    cid, size = pdf["cid"].to_numpy(), len(pdf)
    tokens = [_tokens(bag(t)) for t in pdf["text"]]
    length = np.array([len(t) for t in tokens])
    every = np.concatenate(tokens)
    order = np.argsort(every, kind="stable")
    every, holder = every[order], np.repeat(np.arange(size), length)[order]
    part = np.arange(size)
    links = []

    def join(x: int) -> None:
        low, high = np.searchsorted(every, tokens[x]), np.searchsorted(every, tokens[x], side="right")
        n = high - low
        shared = np.bincount(holder[np.repeat(high - np.cumsum(n), n) + np.arange(n.sum())], minlength=size)
        for y in np.flatnonzero(shared >= similarity * (length + length[x] - shared)):
            if part[x] != part[y]:
                links.append((cid[x], cid[y]))
                part[part == part[y]] = part[x]

    hub = int(np.flatnonzero(cid == pdf["hub"].iat[0])[0])
    join(hub)
    for x in range(size):
        if part[x] != part[hub]:
            join(x)
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def group(docs: DataFrame, similarity: float = SIMILARITY, n_bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, class_id, group_size, kept, loc`` for every row; ``class_id`` is the doc_id of the row of the class that stays."""
    return _group(located(docs), similarity, n_bands, rows)


def _group(placed_docs: DataFrame, similarity: float, n_bands: int, rows: int) -> DataFrame:
    tune(placed_docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    source = placed_docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{place_of(placed_docs)}`").alias("loc"), text)
    flat = with_id(source.select("doc_id", "loc.file", "loc.row", "text"))
    signed = without_id(flat.mapInPandas(_sign(n_bands, rows), "doc_id long, file long, row long, digest binary, bands array<long>"))
    signed = stored(signed.select("doc_id", F.struct("file", "row").alias("loc"), "digest", "bands"), "signed")
    classes = signed.where("digest IS NOT NULL").groupBy("digest").agg(F.min("loc").alias("loc"), F.any_value("bands").alias("bands"))
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")

    entry = classes.select("cid", F.posexplode("bands").alias("band", "key"))
    buckets = entry.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    placed = stored(entry.join(buckets, ["band", "key"]), "placed")
    # The hub of a bucket is the member with the most company over all its buckets: the middle of a group of copies.
    company = placed.groupBy("cid").agg(F.sum("n").alias("company"))
    hubs = placed.join(company, "cid").groupBy("band", "key").agg(F.max(F.struct("company", "cid"))["cid"].alias("hub"))
    members = stored(placed.join(hubs, ["band", "key"]).select("hub", "cid").distinct(), "members")

    needed = members.select("cid").distinct().join(classes.select("cid", "loc"), "cid")
    payload = stored(source.select("loc", "text").join(needed, "loc").select("cid", "text"), "payload")
    blocks = members.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own, others = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"), F.sequence(F.lit(0), F.col("blocks") - 1)
    tasks = F.transform(others, lambda o: F.struct(F.least(own, o).alias("low"), F.greatest(own, o).alias("high")))
    all_tasks = F.flatten(F.transform(others, lambda low: F.transform(
        F.sequence(low, F.col("blocks") - 1), lambda high: F.struct(low.alias("low"), high.alias("high")))))
    dealt = members.join(blocks, "hub").select("hub", "cid", F.explode(F.when(F.col("hub") == F.col("cid"), all_tasks).otherwise(tasks)).alias("task"))
    dealt = dealt.join(payload, "cid").select("hub", "task", "cid", "text")
    links = dealt.groupBy("hub", "task").applyInPandas(lambda pdf: _link(pdf, similarity), "a long, b long")
    parts = components(links)

    known = classes.select("cid", "digest").join(parts.withColumnRenamed("node", "cid"), "cid", "left")
    known = known.select("digest", F.coalesce("component", "cid").alias("component"))
    rows_of = stored(signed.select("doc_id", "loc", "digest").join(known, "digest", "left").select("doc_id", "loc", "component"), "rows")
    # A table of its own, so that the join below has two plain sides and a hot component is cut.
    stays = rows_of.where("component IS NOT NULL").groupBy("component").agg(F.min(F.struct("doc_id", "loc")).alias("keep"), F.count("*").alias("group_size"))
    stays = stored(stays, "stays")
    found = rows_of.where("component IS NOT NULL").join(stays, "component").select(
        "doc_id", F.col("keep.doc_id").alias("class_id"), "group_size", (F.col("keep.loc") == F.col("loc")).alias("kept"), "loc"
    )
    alone = rows_of.where("component IS NULL").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "loc"
    )
    return found.unionByName(alone)


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: one of each group of near duplicates."""
    rows = located(docs)
    kept = _group(rows, SIMILARITY, BANDS, ROWS).where("kept").select(F.col("loc").alias(place_of(rows)))
    return rows.join(kept, place_of(rows), "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
