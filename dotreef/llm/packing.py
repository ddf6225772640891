"""Best-fit decreasing packing of tokenised documents into windows of fixed length.

A document is cut into full windows and a rest. Pieces are dealt over tasks by a hash, as many tasks as the text
needs; each task places its pieces from long to short, every one into the open window with the least room that still takes
it. A segment tree over the remaining room finds that window in a number of steps that does not depend on how many are open.

NULL and empty text: the end token alone. Repeated rows are packed each on their own; ties go by doc_id, start and ids, so a task
that runs again gives the same windows. Extra columns are not read. No input, no windows.
"""

from __future__ import annotations

import base64
import json
import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts, tune, with_id, without_id

#: Bytes of text whose pieces one task packs and holds.
TEXT_PER_TASK = 24 << 20


class Room:
    """Segment tree over remaining room 0..size; a leaf counts the open windows that have exactly that much."""

    def __init__(self, size: int):
        self.base = 1 << size.bit_length()
        self.count = [0] * (2 * self.base)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]

    def put(self, room: int, window: int) -> None:
        self.open[room].append(window)
        node = self.base + room
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Removes and returns (room, window) of the tightest window with at least ``need`` left."""
        count, node = self.count, self.base + need
        while not count[node]:
            while node & 1:  # a right child, or the root: everything above is to the left of here
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.base:
            node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.base
        while node:
            count[node] -= 1
            node >>= 1
        return room, self.open[room].pop()


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Window and offset of each length; lengths come in falling order and none is over ``window``."""
    room, fill, where, offsets = Room(window), [], [], []
    for n in lengths:
        found = room.take(n)
        left, w = found or (window, len(fill))
        if not found:
            fill.append(0)
        where.append(w)
        offsets.append(fill[w])
        fill[w] += n
        if left > n:
            room.put(left - n, w)
    return where, offsets


@cache
def encoder(path: str):
    """Ids as the ``tokenizers`` file at ``path`` gives them, added tokens as their own ids; a rank file encodes faster, with the added
    tokens that the json beside it lists."""
    if path.endswith(".tiktoken"):
        import public_tokenizers
        import tiktoken

        beside = path.removesuffix(".tiktoken") + ".json"
        added = []
        if os.path.exists(beside):
            with open(beside, encoding="utf-8") as file:
                added = json.load(file)["added_tokens"]
        if any(t[rule] for t in added for rule in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{beside}: added tokens with rules of their own; pack with this file instead")
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        special = {t["content"]: t["id"] for t in added}
        own = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        return lambda text: own.encode(text, allowed_special="all")
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    return lambda text: t.encode(text, add_special_tokens=False).ids


PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"
#: Pieces alike in doc_id and start, as documents without an id are, are dealt over so many tasks.
SPREAD = 4096


def pieces(docs: DataFrame, path: str, end_id: int, window: int) -> DataFrame:
    """Every document's ids with the end id, cut into windows; ``ids`` are little-endian unsigned 32-bit numbers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, n = encoder(path), 0
        for pdf in batches:
            rows = []
            for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                ids = np.array([*encode(text), end_id], "<u4")
                for at in range(0, len(ids), window):
                    part = ids[at : at + window]
                    rows.append((doc, at, len(part), len(ids), part.tobytes(), n % SPREAD))
                    n += 1
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "doc_tokens", "ids", "nth"])

    return with_id(texts(docs)).mapInPandas(run, f"{PIECES}, nth int")


def pack(docs: DataFrame, path: str, end_id: int = 1, window: int = 2048, text_per_task: int = TEXT_PER_TASK) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, ids, sequence_id, offset``; ``ids`` are little-endian unsigned 32-bit numbers."""
    tune(docs.sparkSession)
    size = texts(docs).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(1, -(-size // text_per_task))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        pdf = pd.concat(held, ignore_index=True).sort_values(["length", "doc_id", "start", "ids"], ascending=[False, True, True, True])
        where, offsets = best_fit(pdf["length"].tolist(), window)
        pdf["sequence_id"] = (TaskContext.get().partitionId() << 33) + np.array(where, "int64")
        pdf["offset"] = np.array(offsets, "int64")
        for at in range(0, len(pdf), 1000):
            yield pdf.iloc[at : at + 1000]

    dealt = pieces(docs, path, end_id, window).repartition(tasks, "doc_id", "start", "nth").drop("nth")
    return without_id(dealt.mapInPandas(run, f"{PIECES}, sequence_id long, offset long"))
