"""Byte-level BPE through a sentencepiece model written straight from a rank file.

Every rank becomes a piece whose bytes are spelled with one printable character each and whose score is minus its rank, so
that the model merges in rank order. Text is first cut by the vocabulary's own pattern; each piece of that cut is encoded
alone, and ids are decoded by the inverse mapping.

NULL text is empty: no ids. Rows are mapped one by one, so repeated rows and ties stay as they are; other columns are not
read. A text of any length is one row in memory.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable, Sequence
from functools import cache
from itertools import chain

import regex
import sentencepiece
from pyspark.sql import DataFrame

from .common import per_document, texts, tune

#: Distinct cut pieces remembered by one Python worker; the memory starts anew when it is full.
REMEMBERED = 400_000


def byte_characters() -> list[str]:
    """One printable character for each byte: visible Latin-1 as itself, the others from U+0100 on in order."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def _varint(n: int) -> bytes:
    n, out = n & (1 << 64) - 1, bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """The serialised sentencepiece model: piece id = rank, the unknown piece after the last rank."""
    char = byte_characters()
    order = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in order] != list(range(len(order))):
        raise ValueError("ranks are not 0 to n - 1")
    pieces = [
        _block(1, _block(1, "".join(char[b] for b in t).encode()) + b"\x15" + struct.pack("<f", -i) + _number(3, 1)) for i, t in enumerate(order)
    ]
    unknown = _block(1, _block(1, b"<unk>") + b"\x15" + struct.pack("<f", 0.0) + _number(3, 2))
    trainer = _number(3, 2) + _number(40, len(order)) + _number(41, -1) + _number(42, -1) + _number(43, -1)
    normaliser = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(pieces) + unknown + _block(2, trainer) + _block(3, normaliser)


class Codec:
    """Encodes and decodes with one vocabulary; made once per Python worker."""

    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        self.cut = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(ranks))
        self.table = sorted(ranks, key=ranks.get)
        self.chars = str.maketrans(dict(enumerate(byte_characters())))
        self.known: dict[str, tuple[int, ...]] = {}
        # A cut piece that is itself a token keeps its id, also where no chain of merges leads to it.
        found = self.model.encode([t.decode("latin-1").translate(self.chars) for t in self.table], num_threads=1)
        self.unreached = {t: (i,) for i, (t, ids) in enumerate(zip(self.table, found, strict=True)) if ids != [i]}

    def learn(self, words: set[str]) -> None:
        if len(self.known) + len(words) > REMEMBERED:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        raw = [w.encode() for w in new]
        found = self.model.encode([b.decode("latin-1").translate(self.chars) for b in raw], num_threads=1)
        for w, b, ids in zip(new, raw, found, strict=True):
            self.known[w] = self.unreached.get(b) or tuple(ids)

    def encode(self, text: str) -> list[int]:
        words = self.cut(text)
        known = self.known
        try:
            return list(chain.from_iterable([known[w] for w in words]))
        except KeyError:
            self.learn(set(words))
            return list(chain.from_iterable([self.known[w] for w in words]))

    def decode(self, ids: Sequence[int]) -> bytes:
        table = self.table
        return b"".join([table[i] for i in ids])


@cache
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode(
    docs: DataFrame,
    path: str,
    pattern: str,
    columns: Callable[[Codec, list[int]], tuple] | None = None,
    schema: str = "ids array<int>",
) -> DataFrame:
    """``doc_id`` and the ids of each document, or the columns that ``columns(codec, ids)`` makes of them in the same task."""
    tune(docs.sparkSession)
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batch: list[str]) -> dict[str, Sequence]:
        own = codec(path, pattern)
        rows = [(ids,) if columns is None else columns(own, ids) for ids in map(own.encode, batch)]
        return dict(zip(names, zip(*rows, strict=True), strict=True)) if rows else {n: [] for n in names}

    return per_document(texts(docs), run, schema)


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``text`` of ``tokens (doc_id, ids)``; bytes that are no UTF-8 become the replacement character, NULL ids ''."""
    tune(tokens.sparkSession)

    def run(batches):
        own = codec(path, pattern)
        for pdf in batches:
            pdf["text"] = [own.decode(ids if ids is not None else ()).decode("utf-8", "replace") for ids in pdf.pop("ids")]
            yield pdf

    return tokens.selectExpr("cast(doc_id as long) AS doc_id", "cast(ids as array<int>) AS ids").mapInPandas(run, "doc_id long, text string")


def digests(own: Codec, ids: list[int]) -> tuple[int, str, str]:
    """Number of ids, SHA-256 of the ids in decimal, SHA-256 of the bytes that they decode to."""
    line = " ".join(map(str, ids)).encode()
    return len(ids), hashlib.sha256(line).hexdigest(), hashlib.sha256(own.decode(ids)).hexdigest()
