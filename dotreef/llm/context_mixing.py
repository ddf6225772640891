"""Language-model scores by online logistic mixing of hashed-context bit predictors.

A text is its words (A to Z lower-cased) and one end. Each token is coded in binary decisions:

* where the word before it has stood in this document already, whether the token that followed then follows again; if so, that is all;
* eight bits of the token's class, a hash of the bytes at its edges (the end has a class of its own);
* then the token within its class: its share of the class's training tokens, or, for a word that training never saw, the class's share for new
  words (by how many of its words occurred once) times the word spelled in bits of its bytes, or which of the document's own new words it is.

Every bit has several predictors. Each looks up how often the bit was 0 and 1 in training in its own context (the class before, the two classes
before, the word before), hashed into a table of fixed size; one more counts in the document so far. Their log odds are mixed by weights that a gate
selects: which bit it is, and how often training saw the context of two classes. Each document starts from the weights that all training texts
together ask for and refines its own copy as it goes, in steps that double in length, as do its own counts. The sum of all bits is the score,
a probability of the whole text.

What is counted covers every training text and grows with them: tokens, kinds and classes in one table, zeros and ones of each hashed context
in the same. The starting weights are one step of Newton's method from an even mix: slope and curvature are sums over all training texts (over all words seen
once, for the spelling), each bit's own occurrence taken off its counts. Texts are read where they lie, three times. A task sends the distinct words of about
``BATCH_BYTES`` of text to the token table and gets their counts back, so that a frequent word is one row per batch; the vocabulary is never broadcast.

NULL text is empty: its only token is the end. A NULL doc_id is trained on. Rows of one doc_id are texts of their own, repeated rows score alike. Without training
texts the base score is that of one equally likely kind, and every bit of the model costs one bit. Extra columns are not read. Memory of a task grows with its
longest text (some 20 bytes a byte).
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, stored, tune

#: Text that asks for counts at once.
BATCH_BYTES = 8 << 20
#: Texts of one task of the counting pass have this size; the token counts it holds before it sends them. Words of one task and of one step of the spelling.
TASK_BYTES, HELD_TOKENS = 64 << 20, 150_000
TASK_WORDS, STEP_WORDS = 1 << 20, 20_000
#: Tokens of a document's first step; later ones double up to ``STEP_MOST``.
STEP, STEP_MOST = 64, 1 << 16
#: Tokens of the documents that are decided at once.
SLICE = 1 << 16
#: Bits whose evidence is added up at once.
EVIDENCE = 1 << 14
#: Added to the counts of zeros and ones; evidence that holds the starting weights where they were; learning rate of a document.
PRIOR, HOLD, OWN_RATE = 0.4, 16.0, 1.0

U32 = np.uint32
CLASS_BITS, HASH_BITS, SPELL_BITS = 8, 18, 19
CLASSES, SLOTS = 1 << CLASS_BITS, 1 << HASH_BITS
#: Tables of predictors: the class before (one place for each bit of it), and hashed ones for the two classes and the word before.
SIZES = (CLASSES * CLASSES, SLOTS, SLOTS)
BASES = (0, SIZES[0], SIZES[0] + SIZES[1])
TABLE = sum(SIZES)
#: Inputs of the mixer: one for each table and the document's own counts.
INPUTS = len(SIZES) + 1
#: One set of weights for each bit and each bucket of how often training saw its context of two classes.
SEEN = (1, 4, 16)
BUCKETS = len(SEEN) + 1
GATES = (CLASS_BITS + 1) * BUCKETS
LN10 = math.log(10)
END = ""


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 7 == 2


def _class(word: str) -> int:
    raw = word.encode()
    return 1 + zlib.crc32(raw[:2] + b"\0" + raw[-2:]) % (CLASSES - 1) if raw else 0


#: Words up to this many bytes are hashed together, byte by byte; a longer one alone.
_SHORT = 64
_CRC = np.arange(256, dtype=U32)
for _ in range(8):
    _CRC = _CRC >> U32(1) ^ (_CRC & U32(1)) * U32(0xEDB88320)


def _crc(state: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """CRC-32 registers after one more byte each."""
    return _CRC.take((state ^ byte) & U32(255)) ^ state >> U32(8)


def _bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all words, where each starts and how many it has."""
    _, offsets, data = words.buffers()
    edges = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    return np.frombuffer(data if data is not None and data.size else b"\0", np.uint8), edges[:-1], np.diff(edges)


def _classes(words: pa.Array) -> np.ndarray:
    """``_class`` of every word."""
    data, start, size = _bytes(words)
    at = np.flatnonzero(size)
    first, n = start[at], size[at]
    last, two = first + n - 1, n > 1
    state = _crc(np.full(len(at), 0xFFFFFFFF, U32), data[first])
    state = np.where(two, _crc(state, data[np.minimum(first + 1, last)]), state)
    state = _crc(state, np.zeros(len(at), np.uint8))
    state = np.where(two, _crc(state, data[np.maximum(last - 1, first)]), state)
    out = np.zeros(len(words), np.uint8)
    out[at] = 1 + ~_crc(state, data[last]) % U32(CLASSES - 1)
    return out


def _hashes(words: pa.Array) -> np.ndarray:
    """CRC-32 of every word."""
    data, start, size = _bytes(words)
    order = np.argsort(-np.minimum(size, _SHORT + 1), kind="stable")
    start, size = start[order], size[order]
    state = np.full(len(words), 0xFFFFFFFF, U32)
    long = np.count_nonzero(size > _SHORT)
    for k in range(int(size[long]) if long < len(words) else 0):
        n = int(np.searchsorted(-size[long:], -k, side="left"))
        state[long : long + n] = _crc(state[long : long + n], data[start[long : long + n] + k])
    state = ~state
    state[:long] = [zlib.crc32(data[a : a + n]) for a, n in zip(start[:long].tolist(), size[:long].tolist(), strict=True)]
    out = np.empty(len(words), U32)
    out[order] = state
    return out


@dataclass
class Tokens:
    """Texts as tokens: ``ids`` into ``words`` (the end is id 0), the document of each, and where each document starts."""

    words: pa.Array
    ids: np.ndarray
    doc: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> Tokens:
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        if isinstance(lists, pa.ChunkedArray):
            lists = lists.combine_chunks()
        flat, ends = lists.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
        there = pc.not_equal(flat, "")
        before = np.concatenate([[0], np.cumsum(there.to_numpy(zero_copy_only=False))]).astype(np.int64)
        coded = flat.filter(there).dictionary_encode()
        n = len(texts)
        words = np.diff(before[ends])
        sizes = words + 1
        starts = np.concatenate([[0], np.cumsum(sizes)])
        ids = np.zeros(starts[-1], np.int32)
        is_word = np.ones(starts[-1], bool)
        is_word[starts[1:] - 1] = False
        ids[is_word] = coded.indices.to_numpy() + 1
        return cls(pa.concat_arrays([pa.array([END]), coded.dictionary]), ids, np.repeat(np.arange(n, dtype=np.int32), sizes), starts[:-1], sizes)

    @cached_property
    def kinds(self) -> np.ndarray:
        return _classes(self.words)

    @cached_property
    def hashes(self) -> np.ndarray:
        return _hashes(self.words)

    def slices(self) -> Iterator[Tokens]:
        """Documents of about ``SLICE`` tokens at a time, over the same words: what is decided about them needs no others."""
        ends, a = self.starts + self.sizes, 0
        while a < len(self.sizes):
            z = max(a + 1, int(np.searchsorted(ends, self.starts[a] + SLICE, side="right")))
            at = slice(self.starts[a], ends[z - 1])
            part = replace(self, ids=self.ids[at], doc=self.doc[at] - a, starts=self.starts[a:z] - self.starts[a], sizes=self.sizes[a:z])
            part.kinds, part.hashes = self.kinds, self.hashes
            yield part
            a = z


@dataclass
class Decisions:
    """What is decided about each token and in which contexts. ``asked``: is there a word to repeat; ``again``: it was repeated."""

    asked: np.ndarray
    again: np.ndarray
    cls: np.ndarray
    #: Hashes of the contexts of the class bits, and of the question whether the token repeats.
    contexts: tuple[np.ndarray, ...]
    asking: tuple[np.ndarray, ...]

    @classmethod
    def of(cls, t: Tokens) -> Decisions:
        kinds, hashes = t.kinds, t.hashes
        n, first = len(t.ids), t.starts
        before = np.empty(n, np.int32)
        before[1:], before[first] = t.ids[:-1], -1
        key = t.doc.astype(np.int64) * (len(t.words) + 1) + before
        order = np.argsort(key, kind="stable")
        same = np.concatenate([[False], key[order[1:]] == key[order[:-1]]]) if n else np.zeros(0, bool)
        last = np.full(n, -1, np.int32)
        last[order[1:]] = np.where(same[1:], t.ids[order[:-1]], -1)
        asked = last >= 0
        again = asked & (last == t.ids)
        kind = kinds[t.ids]

        def back(values: np.ndarray, by: int) -> np.ndarray:
            out = np.zeros(n, values.dtype)
            out[by:] = values[: max(0, n - by)]
            for k in range(by):
                at = first + k
                out[at[k < t.sizes]] = 0
            return out

        one, two = (back(kind, k).astype(U32) for k in (1, 2))
        word, run = back(hashes[t.ids], 1), back(again, 1) + 2 * back(again, 2).astype(U32)
        guess = hashes[np.maximum(last, 0)]
        kind_of_guess = kinds[np.maximum(last, 0)].astype(U32)
        return cls(asked, again, kind, (one, one * U32(257) + two + U32(1), word), (run, kind_of_guess * U32(269) + run + U32(1 << 20), guess ^ run))


def _hashed(h: np.ndarray, node: np.ndarray, bits: int) -> np.ndarray:
    h = (h ^ node.astype(U32) * U32(0x85EBCA6B)) * U32(0x9E3779B1)
    return (h ^ h >> U32(15)) * U32(0xC2B2AE35) >> U32(32 - bits)


def _slots(contexts: Sequence[np.ndarray], node: np.ndarray) -> list[np.ndarray]:
    """Places of the bit at ``node`` of the class, one in each table."""
    one, *hashed = contexts
    return [place.astype(np.intp) for place in ((one << U32(CLASS_BITS)) + node, *[_hashed(h, node, HASH_BITS) for h in hashed])]


def _bits(d: Decisions, at: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """The decisions about the tokens ``at``, bit by bit: number of the bit, tokens, node, outcome, slots."""
    who = at[d.asked[at]]
    node = np.zeros(len(who), U32)
    yield 0, who, node, d.again[who], _slots([c[who] for c in d.asking], node)
    who = at[~d.again[at]]
    kind, contexts = d.cls[who].astype(U32), [c[who] for c in d.contexts]
    for b in range(CLASS_BITS):
        node = U32(1 << b) + (kind >> U32(CLASS_BITS - b))
        yield b + 1, who, node, (kind >> U32(CLASS_BITS - 1 - b)) & U32(1) == 1, _slots(contexts, node)


def _add(bits, sizes: Sequence[int], zeros: np.ndarray, ones: np.ndarray) -> None:
    """Zeros and ones of the bits, added to those of their slots, table after table."""
    cells: list[list[np.ndarray]] = [[] for _ in sizes]
    for _, _, _, y, slots in bits:
        for held, s in zip(cells, slots, strict=True):
            held.append((2 * s + y).astype(U32))
    base = 0
    for held, size in zip(cells, sizes, strict=True):
        found = _zeros_and_ones(np.concatenate(held), size)
        zeros[base : base + size] += found[0]
        ones[base : base + size] += found[1]
        base += size


def _zeros_and_ones(cells: np.ndarray, size: int) -> np.ndarray:
    """How many bits are 0 (first row) and 1 (second) in each place, from twice the place plus the bit."""
    return np.bincount(cells, minlength=2 * size).reshape(size, 2).T


def count_bits(d: Decisions, zeros: np.ndarray, ones: np.ndarray) -> None:
    _add(_bits(d, np.arange(len(d.cls))), SIZES, zeros, ones)


def _split(table: np.ndarray, sizes: Sequence[int]) -> list[np.ndarray]:
    return np.split(table, np.cumsum(sizes)[:-1])


def _steps(sizes: np.ndarray) -> np.ndarray:
    """The step of each token of documents of the given sizes."""
    pos = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    doubling = int(math.log2(STEP_MOST // STEP))
    edge = STEP * ((1 << doubling) - 1)
    early = np.floor(np.log2(pos // STEP + 1))
    return np.where(pos < edge, early, doubling + (pos - edge) // STEP_MOST).astype(np.int32)


def _outcome(z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Natural log of the probability of the outcomes ``y`` under log odds ``z``, and how far off the prediction was."""
    e = np.exp(-np.abs(z))
    sign = 2 * y.astype(z.dtype) - 1
    # exp(min(z, 0)) is 1 or e: no choice element by element.
    return np.minimum(sign * z, 0) - np.log1p(e), y - np.exp(np.minimum(z, 0)) / (1 + e)


class Mixer:
    """Predictors' tables and starting weights of the class bits; ``weights`` by input and gate."""

    def __init__(self, zeros: np.ndarray, ones: np.ndarray):
        self.odds = _split(np.log((ones + PRIOR) / (zeros + PRIOR)).astype(np.float32), SIZES)
        self.bucket = np.searchsorted(SEEN, _split(zeros + ones, SIZES)[1], side="right").astype(np.uint8)
        self.weights = np.full((INPUTS, GATES), 1 / INPUTS, np.float32)

    def _seen(self, slots: list[np.ndarray]) -> np.ndarray:
        return self.bucket.take(slots[1])

    def _gate(self, b: int, slots: list[np.ndarray]) -> np.ndarray:
        return self._seen(slots) + U32(b * BUCKETS)

    def cost(self, t: Tokens, d: Decisions) -> np.ndarray:
        """Natural log of the probability of all decisions, by document."""
        n_docs = len(t.sizes)
        out = np.zeros(n_docs)
        if not len(t.ids):
            return out
        weights = np.repeat(self.weights[:, None, :], n_docs, 1)
        own = np.full((2, n_docs, CLASSES), PRIOR, np.float32)
        met = np.zeros((n_docs, GATES), np.float32)
        step = _steps(t.sizes)
        order = np.argsort(step, kind="stable")
        edges = np.concatenate([[0], np.cumsum(np.bincount(step))])
        for a, z in zip(edges[:-1], edges[1:], strict=True):
            at = order[a:z]  # documents stay in order inside a step
            doc_of = t.doc[at]
            docs = doc_of[np.concatenate([[True], doc_of[1:] != doc_of[:-1]])]
            k = len(docs)
            place = np.zeros(n_docs, np.int64)
            place[docs] = np.arange(k)
            here = [w[docs] for w in weights]
            mine = np.log(own[1][docs] / own[0][docs]).ravel()
            slope, bits, log = [np.zeros((k, GATES)) for _ in here], np.zeros((k, GATES)), np.zeros(k)
            fresh, who = [], None
            for b, asked, node, y, slots in _bits(d, at):
                if asked is not who:  # the bits of the class are about the same tokens
                    who, doc = asked, place[t.doc[asked]]
                    of_own, of_gate = doc * CLASSES, doc * BUCKETS
                own_cell, cell, gates = of_own + node, of_gate + self._seen(slots), slice(b * BUCKETS, (b + 1) * BUCKETS)
                x = [o.take(s) for o, s in zip(self.odds, slots, strict=True)] + [mine.take(own_cell)]
                found, error = _outcome(sum(w[:, gates].ravel().take(cell) * v for w, v in zip(here, x, strict=True)), y)
                log += np.bincount(doc, found, minlength=k)
                for g, v in zip(slope, x, strict=True):
                    g[:, gates] = np.bincount(cell, error * v, minlength=k * BUCKETS).reshape(k, BUCKETS)
                bits[:, gates] = np.bincount(cell, minlength=k * BUCKETS).reshape(k, BUCKETS)
                fresh.append(2 * own_cell + y)
            # What this step showed is known from the next one on.
            out[docs] += log
            met[docs] += bits
            for w, g in zip(weights, slope, strict=True):
                w[docs] += OWN_RATE * g / (met[docs] + 64)
            own[:, docs] += _zeros_and_ones(np.concatenate(fresh), k * CLASSES).reshape(2, k, CLASSES)
        return out

    def evidence(self, t: Tokens, d: Decisions, odds: Sequence[np.ndarray], found: np.ndarray) -> None:
        """What the texts say about the starting weights, added to ``found`` (``_evidence``). ``odds`` leave a bit's own occurrence out (``_others``)."""
        if not len(t.ids):
            return
        own = np.full((2, len(t.sizes) * CLASSES), PRIOR, np.float32)
        step = _steps(t.sizes)
        order = np.argsort(step, kind="stable")
        edges = np.concatenate([[0], np.cumsum(np.bincount(step))])
        for a, z in zip(edges[:-1], edges[1:], strict=True):
            mine, fresh, who = np.log(own[1] / own[0]), [], None  # as it was before this step
            for b, asked, node, y, slots in _bits(d, order[a:z]):
                if asked is not who:  # the bits of the class are about the same tokens
                    who, of_own = asked, t.doc[asked].astype(np.intp) * CLASSES
                cell, gates = of_own + node, slice(b * BUCKETS, (b + 1) * BUCKETS)
                fresh.append(2 * cell + y)
                x = [o.take(2 * s + y) for o, s in zip(odds, slots, strict=True)] + [mine.take(cell)]
                _evidence(x, y, self._seen(slots), self.weights[:, gates], found[:, :, gates])
            own += _zeros_and_ones(np.concatenate(fresh), own.shape[1])


def _others(zeros: np.ndarray, ones: np.ndarray, sizes: Sequence[int]) -> list[np.ndarray]:
    """Log odds of the slots of each table without the bit that looks them up: of each slot first for a bit that is 0, then for one that is 1."""
    low = np.log((ones + PRIOR) / (np.maximum(zeros - 1, 0) + PRIOR)).astype(np.float32)
    high = np.log((np.maximum(ones - 1, 0) + PRIOR) / (zeros + PRIOR)).astype(np.float32)
    return _split(np.stack([low, high], axis=1).ravel(), [2 * size for size in sizes])


def _evidence(x: Sequence[np.ndarray], y: np.ndarray, bucket: np.ndarray, weights: np.ndarray, found: np.ndarray) -> None:
    """Slope (row 0) and curvature (below) of the log probability of the outcomes ``y`` in the weights, by bucket."""
    weights = weights.astype(np.float64)
    for a in range(0, len(y), EVIDENCE):
        some = bucket[a : a + EVIDENCE]
        order = np.argsort(some, kind="stable")  # eight bits: a radix sort
        edges = np.concatenate([[0], np.cumsum(np.bincount(some, minlength=BUCKETS))]).tolist()
        v, out = np.array([o[a : a + EVIDENCE].take(order) for o in x], np.float64), y[a : a + EVIDENCE].take(order)
        for k, (low, high) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if low < high:
                u = v[:, low:high]
                p = 1 / (1 + np.exp(-(weights[:, k] @ u)))
                found[0, :, k] += u @ (out[low:high] - p)
                found[1:, :, k] += (u * (p * (1 - p))) @ u.T


def _moved(weights: np.ndarray, found: np.ndarray) -> np.ndarray:
    """The weights after one step of Newton's method on the evidence of all texts."""
    slope, curve = found[0].T, found[1:].transpose(2, 0, 1)
    return weights + np.linalg.solve(curve + HOLD * np.eye(len(weights)), slope[:, :, None])[:, :, 0].T


# --- spelling of words that training never saw ----------------------------------------------

SPELL_SIZES = (256 * 256, 256 * CLASSES * 4, *[1 << SPELL_BITS] * 4)
SPELL_TABLE = sum(SPELL_SIZES)


def _spelled(words: Sequence[str] | pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Bits of the bytes of the words, each word closed by a zero byte: bit, word, node, outcome, slots.

    Contexts are the byte before; the class, known by then, and how far into the word it is; two, three and four bytes before; class and byte before.
    """
    words = words if isinstance(words, pa.Array) else pa.array(words, pa.string())
    raw, start, sizes = _bytes(words)
    sizes = sizes + 1
    word = np.repeat(np.arange(len(words)), sizes)
    pos = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    # The zero byte that closes a word stands where the next one starts.
    data = np.where(pos == sizes[word] - 1, 0, raw[np.minimum(start[word] + pos, len(raw) - 1)]).astype(U32)
    cls = np.repeat(_classes(words).astype(U32), sizes)

    def back(by: int) -> np.ndarray:
        out = np.zeros(len(data), U32)
        out[by:] = data[: max(0, len(data) - by)]
        out[pos < by] = 0
        return out

    one, two, three, four = (back(k) for k in (1, 2, 3, 4))
    place = np.minimum(pos, 3).astype(U32)
    pair = one * U32(257) + two * U32(65_537) + U32(1)
    triple = pair * U32(259) + three + U32(2)
    hashes = [pair, triple, triple * U32(261) + four + U32(3), (cls * U32(263) + one) * U32(4) + place + U32(1 << 30)]
    for b in range(8):
        node = U32(1 << b) + (data >> U32(8 - b))
        slots = [one * U32(256) + node, (cls * U32(4) + place) * U32(256) + node, *[_hashed(h, node, SPELL_BITS) for h in hashes]]
        slots = [s.astype(np.intp) for s in slots]
        yield b, word, node, (data >> U32(7 - b)) & U32(1) == 1, slots


class Speller:
    """Bit predictors of the bytes of a word, mixed by weights that the bit and what was seen of four bytes select."""

    def __init__(self, zeros: np.ndarray, ones: np.ndarray):
        self.odds = _split(np.log((ones + PRIOR) / (zeros + PRIOR)).astype(np.float32), SPELL_SIZES)
        self.bucket = np.searchsorted(SEEN, _split(zeros + ones, SPELL_SIZES)[4], side="right").astype(np.uint8)
        self.weights = np.full((len(SPELL_SIZES), 8 * BUCKETS), 1 / len(SPELL_SIZES))

    def evidence(self, words: Sequence[str] | pa.Array, odds: Sequence[np.ndarray], found: np.ndarray) -> None:
        """What the words say about the weights, as ``Mixer.evidence``."""
        for b, _, _, y, slots in _spelled(words):
            x = [o.take(2 * s + y) for o, s in zip(odds, slots, strict=True)]
            _evidence(x, y, self.bucket[slots[4]], self.weights[:, b * BUCKETS : (b + 1) * BUCKETS], found[:, :, b * BUCKETS : (b + 1) * BUCKETS])

    def cost(self, words: Sequence[str]) -> np.ndarray:
        """Natural log of the probability of each word, given its class."""
        out = np.zeros(len(words))
        for a in range(0, len(words), STEP_WORDS):
            some = words[a : a + STEP_WORDS]
            for b, word, _, y, slots in _spelled(some):
                gate = self.bucket[slots[4]] + b * BUCKETS
                x = [o.take(s) for o, s in zip(self.odds, slots, strict=True)]
                out[a : a + len(some)] += np.bincount(word, _outcome(sum(w.take(gate) * v for w, v in zip(self.weights, x, strict=True)), y)[0], minlength=len(some))
        return out


# --- the tables, by Spark ------------------------------------------------------------------

_COUNTS = "token string, slot int, zeros long, ones long"


def _batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.nbytes for x in held) >= size:
            yield pa.Table.from_batches(held)
            held = []
            give_back()
    if held:
        yield pa.Table.from_batches(held)
    give_back()


def _rows(token, slot, zeros, ones) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(token, pa.string()), pa.array(slot, pa.int32()), pa.array(zeros, pa.int64()), pa.array(ones, pa.int64())],
        names=["token", "slot", "zeros", "ones"],
    )


def _table_rows(zeros: np.ndarray, ones: np.ndarray) -> pa.RecordBatch:
    slot = np.flatnonzero(zeros + ones)
    return _rows([None] * len(slot), slot, zeros[slot], ones[slot])


def _added(held: list[pa.Table]) -> pa.Table:
    """Counts of tokens, those of one token added up."""
    return pa.concat_tables(held).group_by("token", use_threads=False).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})


def _token_rows(counted: pa.Table) -> pa.RecordBatch:
    counted = counted.filter(pc.greater(counted.column("n"), 0))
    words = counted.column("token").combine_chunks()
    return _rows(words, -1 - _classes(words).astype(np.int32), np.zeros(len(words), np.int64), counted.column("n").combine_chunks())


def statistics(training: DataFrame, size: int) -> DataFrame:
    """``token, slot, zeros, ones``: a token with its count in ``ones`` and its class as the slot -1 - class, or the counts of a slot under token NULL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        zeros, ones = np.zeros(TABLE, np.int64), np.zeros(TABLE, np.int64)
        for table in _batches(batches, BATCH_BYTES // 2):
            t = Tokens.of(table.column(0).combine_chunks())
            for some in t.slices():
                count_bits(Decisions.of(some), zeros, ones)
            held.append(pa.table({"token": t.words, "n": np.bincount(t.ids, minlength=len(t.words))}))
            if sum(h.num_rows for h in held) > HELD_TOKENS:
                held = [_added(held)]
                if held[0].num_rows > HELD_TOKENS:
                    yield _token_rows(held.pop())
        if held:
            yield _token_rows(_added(held))
        yield _table_rows(zeros, ones)

    # Few tasks, as each sends a table of its own; a scan is put together without an exchange.
    tasks = max(8, -(-size // TASK_BYTES))
    made = training.select("text").coalesce(tasks).mapInArrow(run, _COUNTS)
    return made.groupBy("token", "slot").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))


def _dense(df: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts by slot; as many rows as the table has slots, at most."""
    found = df.select("slot", "zeros", "ones").toArrow()
    out = np.zeros((2, size), np.int64)
    slot = found.column("slot").to_numpy()
    out[0][slot], out[1][slot] = found.column("zeros").to_numpy(), found.column("ones").to_numpy()
    return out[0], out[1]


def spelling(tokens: DataFrame) -> Speller:
    """Learned from the words that training saw once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zeros, ones = np.zeros(SPELL_TABLE, np.int64), np.zeros(SPELL_TABLE, np.int64)
        for table in _batches(batches, 1 << 20):
            words = table.column(0).combine_chunks()
            for a in range(0, len(words), STEP_WORDS):
                _add(_spelled(words[a : a + STEP_WORDS]), SPELL_SIZES, zeros, ones)
        yield _table_rows(zeros, ones)

    once = tokens.where("ones = 1").select("token")
    tasks = max(1, once.count() // TASK_WORDS)
    counted = once.coalesce(tasks).mapInArrow(run, _COUNTS).groupBy("slot").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))
    zeros, ones = _dense(counted, SPELL_TABLE)
    speller, odds = Speller(zeros, ones), _others(zeros, ones, SPELL_SIZES)

    def learn(found: np.ndarray, table: pa.Table) -> None:
        words = table.column(0).combine_chunks()
        for a in range(0, len(words), STEP_WORDS):
            speller.evidence(words[a : a + STEP_WORDS], odds, found)

    speller.weights = _learned(once.coalesce(tasks), speller.weights, learn, 1 << 20)
    return speller


def _learned(rows: DataFrame, weights: np.ndarray, learn: Callable[[np.ndarray, pa.Table], None], size: int) -> np.ndarray:
    """``weights`` moved by the evidence that ``learn`` finds in all ``rows``, each task adding up its own."""
    shape = (len(weights) + 1, *weights.shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(shape)
        for table in _batches(batches, size):
            learn(found, table)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(found.ravel()[at])], names=["at", "value"])

    sums = rows.mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    found = np.zeros(shape)
    found.flat[sums.column("at").to_numpy()] = sums.column("value").to_numpy()
    return _moved(weights, found).astype(weights.dtype)


@dataclass
class Model:
    mixer: Mixer
    speller: Speller
    #: Training tokens, kinds and kinds seen once, by class.
    tokens: np.ndarray
    kinds: np.ndarray
    single: np.ndarray

    def base(self, count: np.ndarray) -> np.ndarray:
        """log10 of the smoothed share of tokens with these counts."""
        return np.log10((count + 1) / (int(self.tokens.sum()) + int(self.kinds.sum()) + 1))

    def within(self, doc: np.ndarray, ids: np.ndarray, words: Sequence[str | None], cls: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Natural log of each token's probability within its class. ``words``, ``cls`` and ``count`` are by id; a word is needed only where its count is 0.

        Among words that training never saw, one that its document has had already is told by which of these of its class it is; only a new one is spelled.
        """
        fresh = (self.single[cls] + 1) / (self.tokens[cls] + 2)
        known = np.log(np.maximum(count, 1) / np.maximum(self.tokens[cls], 1)) + np.log1p(-fresh)
        known[cls == 0] = 0.0  # the end is alone in its class
        unseen = (count == 0) & (cls != 0)
        which = np.flatnonzero(unseen)
        costs = self.speller.cost([words[i] for i in which]) if len(which) else which
        spelled = dict(zip(which.tolist(), costs.tolist(), strict=True))
        out = known[ids]
        at = np.flatnonzero(unseen[ids])
        place, met, asked, repeated = -1, {}, 0, 0
        for i, d, word in zip(at.tolist(), doc[at].tolist(), ids[at].tolist(), strict=True):
            if d != place:
                place, met, asked, repeated = d, {}, 0, 0
            c = int(cls[word])
            mine = met.setdefault(c, set())
            cost = math.log(fresh[word])
            if mine:
                again = (repeated + 0.5) / (asked + 1)
                asked += 1
                if word in mine:
                    repeated += 1
                    out[i] = cost + math.log(again / len(mine))
                    continue
                cost += math.log1p(-again)
            mine.add(word)
            out[i] = cost + spelled[word]
        return out


def fit(rows: DataFrame, size: int) -> tuple[Model, DataFrame]:
    """The model, and ``token, count`` of every training token, from ``rows (text, held_out)``."""
    training = rows.where("NOT held_out")
    found = stored(statistics(training, size), "statistics")
    tokens = found.where("token IS NOT NULL")
    by_class = tokens.groupBy("slot").agg(F.sum("ones").alias("n"), F.count("*").alias("kinds"), F.count_if(F.col("ones") == 1).alias("single")).collect()
    sums = np.zeros((3, CLASSES), np.int64)
    for r in by_class:
        sums[:, -1 - r["slot"]] = r["n"], r["kinds"], r["single"]
    zeros, ones = _dense(found.where("token IS NULL"), TABLE)
    mixer, odds = Mixer(zeros, ones), _others(zeros, ones, SIZES)

    def learn(found: np.ndarray, table: pa.Table) -> None:
        for some in Tokens.of(table.column(0).combine_chunks()).slices():
            mixer.evidence(some, Decisions.of(some), odds, found)

    mixer.weights = _learned(training.select("text"), mixer.weights, learn, BATCH_BYTES // 2)
    return Model(mixer, spelling(tokens.where("token <> ''")), *sums), tokens.select("token", F.col("ones").alias("count"))


# --- scoring -------------------------------------------------------------------------------

_PART = "batch long, id int, token string, payload binary"
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"


def coded(rows: DataFrame, model: Model) -> DataFrame:
    """Per batch of texts one row with its tokens and the cost of their decisions, and one row for each distinct word."""
    mixer = model.mixer

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 24
        for i, table in enumerate(_batches(batches, BATCH_BYTES)):
            texts = table.column("text").combine_chunks()
            t = Tokens.of(texts)
            cost, again = [], []
            for some in t.slices():
                d = Decisions.of(some)
                cost.append(mixer.cost(some, d))
                again.append(d.again)
            sizes = pa.array(t.sizes, pa.int64())
            length = pc.cast(pc.binary_length(texts), pa.int64())
            docs = pa.table([table.column("doc_id").combine_chunks(), table.column("held_out").combine_chunks(), sizes, length, pa.array(np.concatenate(cost))],
                            names=["doc_id", "held_out", "n", "bytes", "cost"])
            sink, packed = pa.BufferOutputStream(), pa.Codec("zstd", 1)
            with pa.ipc.new_stream(sink, docs.schema) as w:
                w.write_table(docs)
            ids = (t.ids.astype(np.int32) << 1) | np.concatenate(again)
            n = len(t.words)
            size = np.array([sink.tell(), n, len(ids)], np.int64).tobytes()
            payload = size + sink.getvalue().to_pybytes() + t.kinds.tobytes() + packed.compress(ids.astype(np.int32).tobytes()).to_pybytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n + 1, base + i), pa.int64()), pa.array(np.arange(-1, n), pa.int32()), pa.concat_arrays([pa.nulls(1, pa.string()), t.words]),
                 pa.array([payload] + [None] * n, pa.binary())], names=["batch", "id", "token", "payload"],
            )

    return rows.select("doc_id", "held_out", "text").mapInArrow(run, _PART)


def _unpack(payload: bytes) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """Documents, class of each word, and of each token its word and whether it was repeated."""
    size, words, n = np.frombuffer(payload[:24], np.int64).tolist()
    docs, at = pa.ipc.open_stream(payload[24 : 24 + size]).read_all(), 24 + size
    kinds = np.frombuffer(payload[at : at + words], np.uint8)
    ids = np.frombuffer(pa.Codec("zstd").decompress(payload[at + words :], decompressed_size=4 * n), np.int32)
    return docs, kinds, ids >> 1, (ids & 1).astype(bool)


def _scored(model: Model):
    total = int(model.tokens.sum())

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        give_back()
        docs, kinds, ids, again = _unpack(left["payload"].iloc[0])
        n = len(right)
        count, words = np.zeros(n, np.int64), np.empty(n, object)
        at = right["id"].to_numpy()
        count[at], words[at] = right["count"].to_numpy(), right["token"].to_numpy()
        cls = kinds.astype(np.int64)
        sizes = docs.column("n").to_numpy()
        doc = np.repeat(np.arange(len(sizes)), sizes)
        inside, base = model.within(doc[~again], ids[~again], words, cls, count), model.base(count)
        of = lambda v, at=slice(None): np.bincount(doc[at], v, minlength=len(sizes))
        score = (docs.column("cost").to_numpy() + of(inside, ~again)) / LN10
        length = docs.column("bytes").to_numpy()
        return pd.DataFrame({
            "doc_id": pd.array(docs.column("doc_id").to_pylist(), "Int64"), "held_out": docs.column("held_out").to_pandas(), "n_tokens": sizes,
            "n_known": of(count[ids] > 0).astype(np.int64), "train_tokens": total, "base_score": of(base[ids]), "score": score,
            "bits_per_byte": np.where(length > 0, -score / math.log10(2) / np.maximum(length, 1), np.nan),
        })

    return run


def score(docs: DataFrame) -> DataFrame:
    """``RESULT`` of every row of ``docs``, learned from those that are not held out."""
    tune(docs.sparkSession)
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    model, tokens = fit(rows, size)
    parts = stored(coded(rows, model), "coded")
    asked = parts.where("payload IS NULL").select("batch", "id", "token").join(tokens, "token", "left")
    known = F.col("count").isNotNull()

    # The word itself is needed only where it has to be spelled.
    asked = asked.select("batch", "id", F.when(known, F.lit(None)).otherwise(F.col("token")).alias("token"), F.when(known, F.col("count")).otherwise(F.lit(0)).alias("count"))
    whole = parts.where("payload IS NOT NULL").select(F.col("batch").alias("whole"), "payload")  # both sides come from one table: a name of its own
    return whole.groupBy("whole").cogroup(asked.groupBy("batch")).applyInPandas(_scored(model), RESULT)
