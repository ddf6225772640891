"""Removal of long byte strings that occur more than once, by window minima and counted fingerprints.

This is not prefix doubling: no position is sorted or ranked (README says why). Every window of ``length`` bytes chooses one position inside it, the one
whose next ``2 * half`` bytes hash lowest, so equal windows choose at equal offsets wherever they stand. Only chosen positions are looked at (about one
in fifty bytes): the fingerprint of ``half`` bytes there and that of the next ``half`` make a pair, pairs are counted, and positions with a pair of their own
drop out. Survivors get the bytes of all windows that chose them. Equal ones among these settle all those windows at once; where they differ in part, each
single window is named and counted. Contexts and single windows go by the MD5 of their bytes, which stands for them; the 64-bit fingerprints of halves
only choose what is looked at.

Texts are UTF-8 bytes, matches never cross texts. NULL is the empty text; a text shorter than ``length`` has no window. Repeated rows are
texts that repeat each other, both are removed. Strings that overlap themselves count. Extra columns are not read. A long text
is worked through in segments of bounded size.

``passages`` finds shorter repeats by the same steps over words instead of bytes: strings of at least ``WORDS`` words that stand in another document as
well. They are reported and not removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import located, place_of, stored, tune

LENGTH = 400
#: Words of the shortest passage that is reported.
WORDS = 50
#: Windows of one segment of a text.
SEGMENT = 1 << 19
# An odd multiplier; arithmetic is modulo 2 ** 64.
BASE = 0x9E3779B97F4A7C15
_U = np.uint64
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 to base ** n."""
    table = _powers.get(base)
    if table is None or len(table) <= n:
        size = 1 << (n + 1).bit_length()
        table = np.cumprod(np.concatenate([np.ones(1, _U), np.full(size, base, _U)]), dtype=_U)
        _powers[base] = table
    return table[: n + 1]


@cache
def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


class Names:
    """64-bit names of substrings of ``data``: differences of one running sum, moved to a common place."""

    def __init__(self, data: np.ndarray, base: int):
        self.sums = np.zeros(len(data) + 1, _U)
        np.cumsum((data.astype(_U) + _U(1)) * _power(base, len(data))[:-1], out=self.sums[1:])
        self.back = _power(_inverse(base), len(data))

    def at(self, starts: np.ndarray, size: int) -> np.ndarray:
        """Names of ``size`` bytes at the given starts."""
        return (self.sums[starts + size] - self.sums[starts]) * self.back[starts]

    def every(self, size: int) -> np.ndarray:
        """Names of ``size`` bytes at every start."""
        return (self.sums[size:] - self.sums[: len(self.sums) - size]) * self.back[: len(self.sums) - size]


def _segments(n: int, length: int, size: int | None = None) -> Iterator[tuple[int, int]]:
    """(first byte or word, the one after the last) of segments whose windows make up the text's windows."""
    size = size or SEGMENT
    for at in range(0, n - length + 1, size):
        yield at, min(n, at + size + length - 1)


def choose(key: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chosen positions of one segment with the first and last window that chose each; ``key`` names what follows a position, a window has ``span`` positions."""
    windows = len(key) - span + 1
    key = (key ^ (key >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    # The low bits hold the position: the leftmost of equal hashes is the least.
    key = (key >> _U(20) << _U(20)) | np.arange(len(key), dtype=_U)
    size = 1
    while 2 * size <= span:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    if size < span:
        key = np.minimum(key[: len(key) - (span - size)], key[span - size :])
    chosen = (key & _U((1 << 20) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    last = np.concatenate([first[1:] - 1, [windows - 1]])
    return chosen[first], first, last


def _byte_parts(raw: bytes, length: int, half: int) -> Iterator[tuple]:
    """Segments of a text: its place, first and last windows of the chosen positions, names of both halves, bytes, begins and ends of the contexts in them."""
    for at, end in _segments(len(raw), length):
        part = memoryview(raw)[at:end]
        own = Names(np.frombuffer(part, np.uint8), BASE)
        pos, first, last = choose(own.every(2 * half), length - 2 * half + 1)
        yield at, first, last, own.at(pos, half), own.at(pos + half, half), part, first, last + length


#: Letters in small, digits and whatever is not ASCII; the rest parts words.
_LETTERS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def _worded(raw: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of a text with one blank between them, and where each begins and ends."""
    plain = b" ".join(raw.translate(_LETTERS).split())
    if not plain:
        return plain, np.empty(0, np.int64), np.empty(0, np.int64)
    blanks = np.flatnonzero(np.frombuffer(plain, np.uint8) == 32)
    return plain, np.concatenate([[0], blanks + 1]), np.concatenate([blanks, [len(plain)]])


def _word_parts(raw: bytes, length: int, half: int) -> Iterator[tuple]:
    """Like ``_byte_parts``, windows being of words."""
    plain, begins, ends = _worded(raw)
    for at, end in _segments(len(begins), length, SEGMENT >> 3):
        zero = begins[at]
        part = memoryview(plain)[zero : ends[end - 1]]
        begin, stop = begins[at:end] - zero, ends[at:end] - zero
        own = Names(np.frombuffer(part, np.uint8), BASE)
        name = lambda i, n: own.at(begin[i], stop[i + n - 1] - begin[i])  # noqa: B023, E731
        pos, first, last = choose(name(np.arange(end - at - 2 * half + 1), 2 * half), length - 2 * half + 1)
        yield at, first, last, name(pos, half), name(pos + half, half), part, begin[first], stop[last + length - 1]


def _arrow_rows(names: list[str], kinds: list[pa.DataType], cols: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)


_LONG, _BIN = pa.int64(), pa.binary()


def _positions(parts: Callable[[bytes, int, int], Iterator[tuple]], length: int, half: int, contexts: bool):
    """Maps (file, row, text) to one row per chosen position: the pair of names, and where asked its place and context."""
    names = ["one", "two"] + (["file", "row", "low", "high", "context"] if contexts else [])
    kinds = [_LONG] * (len(names) - 1) + [_BIN] if contexts else [_LONG] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in names]
            held = 0
            for file, row, text in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                for at, first, last, one, two, part, begins, ends in parts(text.encode(), length, half):
                    made = [one.view(np.int64), two.view(np.int64)]
                    if contexts:
                        n = len(first)
                        cut = [hashlib.md5(part[i:j]).digest() for i, j in zip(begins.tolist(), ends.tolist(), strict=True)]
                        made += [np.full(n, file), np.full(n, row), first + at, last + at, cut]
                    held += len(one)
                    for c, m in zip(cols, made, strict=True):
                        c.append(m)
                if held > 100_000:
                    yield _arrow_rows(names, kinds, [_joined(c) for c in cols])
                    cols, held = [[] for _ in names], 0
            yield _arrow_rows(names, kinds, [_joined(c) for c in cols])

    schema = "one long, two long" + (", file long, row long, low long, high long, context binary" if contexts else "")
    return run, schema


def _joined(parts: list):
    if not parts:
        return []
    return [x for p in parts for x in p] if isinstance(parts[0], list) else np.concatenate(parts)


def _windows(length: int, words: bool = False):
    """Maps (file, row, text, spans) to one row per window of the spans: its digest and place."""
    names = ["file", "row", "at", "single", "name"]
    kinds = [_LONG, _LONG, _LONG, pa.bool_(), _BIN]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in names]
            held = 0
            for i, (file, row, text) in enumerate(zip(*(b.column(i).to_pylist() for i in range(3)), strict=True)):
                raw, begins, ends = _worded(text.encode()) if words else (text.encode(), None, None)
                raw = memoryview(raw)
                for code in b.column(3)[i].values.to_pylist():
                    low, n = code >> 1 >> _WIDTH, (code >> 1 & (1 << _WIDTH) - 1) + 1
                    if words:
                        cuts = zip(begins[low : low + n].tolist(), ends[low + length - 1 : low + length - 1 + n].tolist(), strict=True)
                    else:
                        cuts = zip(range(low, low + n), range(low + length, low + length + n), strict=True)
                    made = (np.full(n, file), np.full(n, row), np.arange(low, low + n), np.full(n, code & 1 == 1),
                            [hashlib.md5(raw[i:j]).digest() for i, j in cuts])
                    held += n
                    for c, m in zip(cols, made, strict=True):
                        c.append(m)
                    if held > 100_000:
                        yield _arrow_rows(names, kinds, [_joined(c) for c in cols])
                        cols, held = [[] for _ in names], 0
            yield _arrow_rows(names, kinds, [_joined(c) for c in cols])

    return run, "file long, row long, at long, single boolean, name binary"


#: Bits for the number of windows of a span that follow its first one; a span is at most a segment.
_WIDTH = 20


def _span(low: str, high: str):
    """A span of windows as one number."""
    return F.shiftleft(F.col(low), _WIDTH) + F.col(high) - F.col(low)


def covered(spans: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs that the windows of coded spans cover."""
    if not len(spans):
        return []
    spans = np.sort(spans)
    low = spans >> _WIDTH
    end = np.maximum.accumulate(low + (spans & (1 << _WIDTH) - 1) + length)
    new = np.flatnonzero(np.concatenate([[True], low[1:] > end[:-1]]))
    return list(zip(low[new].tolist(), end[np.concatenate([new[1:] - 1, [len(end) - 1]])].tolist(), strict=True))


def cut(raw: bytes, spans: np.ndarray, length: int) -> tuple[bytes, list[tuple[int, int]]]:
    """The bytes that remain, and the maximal removed runs, for coded spans of repeated windows."""
    runs = covered(spans, length)
    out, at = [], 0
    for a, b in runs:
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]]), runs


def _source(docs: DataFrame, least: int) -> DataFrame:
    """``file, row, text`` of located rows whose text has that many bytes."""
    place = f"`{place_of(docs)}`"
    source = docs.select(f"{place}.file", f"{place}.row", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return source.where(F.octet_length("text") >= least)


def repeated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``file, row, spans`` of every located row with windows that occur anywhere else; a span is one number for the first window and how many follow."""
    tune(docs.sparkSession)
    half = 3 * length // 8
    long_enough = _source(docs, length)

    run, schema = _positions(_byte_parts, length, half, contexts=False)
    pairs = long_enough.mapInArrow(run, schema).groupBy("one", "two").agg(F.count("*").alias("n")).where("n > 1").select("one", "two")
    pairs = stored(pairs, "pairs")
    run, schema = _positions(_byte_parts, length, half, contexts=True)
    hits = stored(long_enough.mapInArrow(run, schema).join(pairs, ["one", "two"]), "hits")

    place = F.struct("file", "row", "low", "high").alias("place")
    classes = hits.groupBy("one", "two", "context").agg(F.count("*").alias("n"), F.min(place).alias("place"))
    classes = stored(classes, "classes")
    settled = hits.join(classes.where("n > 1").select("one", "two", "context"), ["one", "two", "context"]).select("file", "row", "low", "high")

    # Pairs with a context of their own: their windows are named one by one, one member standing for equal contexts.
    partly = stored(classes.groupBy("one", "two").agg(F.min("n").alias("least")).where("least = 1").select("one", "two"), "partly")
    asked = classes.join(partly, ["one", "two"]).select("place.*", (F.col("n") == 1).alias("single"))
    code = F.shiftleft(_span("low", "high"), 1) + F.col("single").cast("long")
    asked = asked.groupBy("file", "row").agg(F.collect_list(code).alias("spans"))
    run, schema = _windows(length)
    windows = stored(long_enough.join(asked, ["file", "row"]).select("file", "row", "text", "spans").mapInArrow(run, schema), "windows")
    twice = windows.groupBy("name").agg(F.count("*").alias("n"), F.max("single").alias("any")).where("n > 1 AND any").select("name")
    twice = stored(twice, "twice")  # its own table: the join's sides are then plain exchanges, and hot names are cut
    late = windows.where("single").join(twice, "name").select("file", "row", F.col("at").alias("low"), F.col("at").alias("high"))
    return settled.unionByName(late).groupBy("file", "row").agg(F.collect_list(_span("low", "high")).alias("spans"))


#: Rows of more than one document, by their places.
_APART = "(min(file) <> max(file) OR min(row) <> max(row))"


def passages(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``file, row, spans`` of every located row with strings of ``words`` words that stand in another row as well; coded as in ``repeated``, in words.

    The steps are those of ``repeated``. What repeats in one document alone is no passage, but its places count where another document has a part of it.
    """
    tune(docs.sparkSession)
    half = max(1, words // 10)
    long_enough = _source(docs, 2 * words - 1)
    name, context = ["one", "two"], ["one", "two", "context"]

    run, schema = _positions(_word_parts, words, half, contexts=False)
    pairs = long_enough.mapInArrow(run, schema).groupBy(*name).agg(F.count("*").alias("n")).where("n > 1").select(*name)
    pairs = stored(pairs, "word_pairs")
    run, schema = _positions(_word_parts, words, half, contexts=True)
    hits = stored(long_enough.mapInArrow(run, schema).join(pairs, name), "word_hits")

    ends = [F.min("file").alias("file"), F.max("file").alias("top_file"), F.min("row").alias("row"), F.max("row").alias("top_row")]
    place = F.min(F.struct("file", "row", "low", "high")).alias("place")
    classes = hits.groupBy(*context).agg(F.expr(_APART).alias("shared"), place, *ends)
    classes = stored(classes, "word_classes")
    # Pairs in several documents of which a context stands in one alone: its windows are named one by one.
    apart = F.expr("min(file) <> max(top_file) OR min(row) <> max(top_row)")
    partly = classes.groupBy(*name).agg(F.min("shared").alias("settled"), apart.alias("apart")).where("apart AND NOT settled").select(*name)
    partly = stored(partly, "word_partly")
    open_ = classes.join(partly, name).select(*context, "shared", "place")
    asked = classes.where("shared").select(*context, "shared").unionByName(open_.where("NOT shared").select(*context, "shared"))
    placed = stored(hits.join(asked, context).select("file", "row", "low", "high", "shared"), "word_places")

    code = lambda single: (F.shiftleft(_span("low", "high"), 1) + F.lit(single)).alias("code")
    singles = placed.where("NOT shared").select("file", "row", code(1))
    others = open_.where("shared").select("place.*").select("file", "row", code(0))
    wanted = singles.unionByName(others).groupBy("file", "row").agg(F.collect_list("code").alias("spans"))
    run, schema = _windows(words, words=True)
    windows = long_enough.join(wanted, ["file", "row"]).select("file", "row", "text", "spans").mapInArrow(run, schema)
    windows = stored(windows, "word_windows")
    twice = windows.groupBy("name").agg(F.expr(f"bool_or(single) AND (NOT bool_and(single) OR {_APART})").alias("shared")).where("shared").select("name")
    twice = stored(twice, "word_twice")
    late = windows.where("single").join(twice, "name").select("file", "row", F.col("at").alias("low"), F.col("at").alias("high"))
    found = placed.where("shared").select("file", "row", "low", "high").unionByName(late)
    return found.groupBy("file", "row").agg(F.collect_list(_span("low", "high")).alias("spans"))


def remove(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept`` of every row; spans are maximal removed runs, ``kept`` the remaining bytes."""
    return _removed(docs, length, "kept binary", lambda raw: raw)


def digests(docs: DataFrame, length: int = LENGTH, words: int = WORDS) -> DataFrame:
    """Like ``remove``, with the SHA-256 of the remaining bytes in place of the bytes and with ``passages``, maximal runs of words (counted from 0) that
    strings of ``words`` words cover which stand in another row as well."""
    return _removed(docs, length, "kept_sha256 string", lambda raw: hashlib.sha256(raw).hexdigest(), words)


_RUNS = "array<struct<start: long, end: long>>"


def _removed(docs: DataFrame, length: int, column: str, of, words: int | None = None) -> DataFrame:
    placed = located(docs)
    place = f"`{place_of(placed)}`"
    spans = stored(repeated(placed, length), "spans")
    rows = placed.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                         F.col(f"{place}.file").alias("file"), F.col(f"{place}.row").alias("row"))
    name, kind = column.split()
    joined = rows.join(spans, ["file", "row"], "left").select("file", "row", "doc_id", "text", "spans")
    schema = f"doc_id long, n_bytes long, n_removed long, spans {_RUNS}, {column}"
    if words:
        shared = stored(passages(placed, words), "passages").withColumnRenamed("spans", "shared")
        joined = joined.join(shared, ["file", "row"], "left")
        schema += f", passages {_RUNS}"
    plain = pa.list_(pa.struct([("start", _LONG), ("end", _LONG)]))
    kinds = [_LONG, _LONG, plain, _BIN if kind == "binary" else pa.string(), *[plain] * bool(words)]
    names = ["doc_id", "n_bytes", "n_removed", "spans", name, *["passages"] * bool(words)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded = lambda found: found.values.to_numpy() if found.is_valid else ()
        told = lambda runs: [{"start": a, "end": e} for a, e in runs]
        for b in batches:
            out = []
            for i, text in enumerate(b.column(1).to_pylist()):
                raw = text.encode()
                rest, runs = cut(raw, coded(b.column(2)[i]), length)
                out.append((len(raw), len(raw) - len(rest), told(runs), of(rest), *([told(covered(coded(b.column(3)[i]), words))] if words else [])))
            cols = [pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=names)

    return joined.drop("file", "row").mapInArrow(run, schema)
