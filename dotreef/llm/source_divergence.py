"""How the sources of a language differ in their words, from an index built in a single pass.

Indexing: a task collects postings (term, source, occurrences, documents) of its texts in memory; when the block is full it is spilled as a run,
sorted by term and cut by hash shard of the term. Runs meet per shard in one exchange, where a heap merges them into frequencies; very many runs
merge in levels of ``FAN_IN``. A term is then whole in one place, so that rare ones drop out there. A frequent term is one posting per run and
source, never a row per occurrence.

Smoothed shares are compared by corrections: two groups that both lack a term differ by the same amount for every such term, so that the base of a
pair is that amount times the number of terms. Terms that one group has correct the base for the other by a function of one number (sums over
sorted shares), terms that both have are corrected pair by pair while postings stream by. Corrections are added up per task.

NULL text, lang and source are empty. A text without terms still makes its group occur. All arithmetic is in whole numbers: shares are
floor divisions done in three decimal steps, exact while a language has fewer than 9e15 kept words. Ties in value go by the bytes of the item. Repeated
rows are documents of their own, extra columns are not read, doc_id is not used; no row gives no result. A long text is cut into words piece by piece.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored, tune

#: Documents of its language that a term must occur in, what is added to each count, and the length of the list of terms.
LEAST_DOCS, SMOOTHING, TOP = 30, 5, 50
SCALE = 1_000_000_000
#: Postings that a block holds before it is spilled, runs that one merge takes, bytes of text for one shard, postings in one row of frequencies.
BLOCK, FAN_IN, SHARD_BYTES, ROW = 400_000, 256, 8 << 20, 1 << 16
#: Text per run, a cautious guess that only decides how many levels of merging there are, and the piece of a text worked on at once.
RUN_BYTES, PIECE = 4 << 20, 1 << 20
#: Cells of the matrix of pairs that a task adds up at once.
CELLS = 1 << 20

# Letters a term is made of; A to Z are lower-cased, all other bytes below 128 separate.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

RUN = "lang string, shard int, part int, names array<string>, terms array<binary>, docs array<long>, posts array<int>, src array<int>, tf array<long>"
_SCHEMA = pa.schema([
    ("lang", pa.string()), ("shard", pa.int32()), ("part", pa.int32()), ("names", pa.list_(pa.string())), ("terms", pa.list_(pa.binary())),
    ("docs", pa.list_(pa.int64())), ("posts", pa.list_(pa.int32())), ("src", pa.list_(pa.int32())), ("tf", pa.list_(pa.int64())),
])


def pieces(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, list by list."""
    raw = text.encode().translate(_FOLD)
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + PIECE) if at + PIECE < len(raw) else -1
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def _lists(values: pa.Array, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _rows(lang: str, part: int, names: Sequence[str], shards: np.ndarray, terms: Sequence[bytes], docs, posts, src, tf) -> pa.RecordBatch:
    """Terms in order of (row, term) as one row for each run of equal ``shards``; ``posts`` says how many postings each term has."""
    cut = np.flatnonzero(np.concatenate([[True], shards[1:] != shards[:-1]])) if len(shards) else np.zeros(0, np.int64)
    at = np.concatenate([cut, [len(shards)]])
    ends = np.concatenate([[0], np.cumsum(posts)])
    n = len(cut)
    named = _lists(pa.array(list(names) * n, pa.string()), np.arange(n + 1) * len(names))
    columns = [
        pa.array([lang] * n, pa.string()), pa.array(shards[cut], pa.int32()), pa.array([part] * n, pa.int32()), named,
        _lists(pa.array(terms, pa.binary()), at), _lists(pa.array(docs, pa.int64()), at), _lists(pa.array(posts, pa.int32()), at),
        _lists(pa.array(src, pa.int32()), ends[at]), _lists(pa.array(tf, pa.int64()), ends[at]),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)


class Block:
    """Postings in memory: per language documents by term, and occurrences by source and term."""

    def __init__(self) -> None:
        self.langs: dict[str, tuple[Counter, dict[str, Counter]]] = {}
        self.size = 0

    def add(self, lang: str, source: str, text: str) -> None:
        docs, sources = self.langs.setdefault(lang, (Counter(), {}))
        tf = sources.setdefault(source, Counter())
        before, seen = len(docs) + len(tf), set()
        for words in pieces(text):
            tf.update(words)
            seen.update(words)
        docs.update(seen)
        self.size += len(docs) + len(tf) - before

    def spill(self, shards: int, part: int) -> Iterator[pa.RecordBatch]:
        """One run per language, its slices in order of shard, terms sorted in each; the block is empty then."""
        for lang, (docs, sources) in self.langs.items():
            names, terms = list(sources), sorted(docs)
            if not terms:
                continue
            shard = np.fromiter((zlib.crc32(t) % shards for t in terms), np.int32, len(terms))
            order = np.argsort(shard, kind="stable")
            rank = dict(zip((terms[i] for i in order), range(len(terms)), strict=True))
            at = np.concatenate([np.fromiter((rank[t] for t in c), np.int64, len(c)) for c in sources.values()])
            src = np.repeat(np.arange(len(names), dtype=np.int32), [len(c) for c in sources.values()])
            tf = np.concatenate([np.fromiter(c.values(), np.int64, len(c)) for c in sources.values()])
            by_term = np.argsort(at, kind="stable")
            yield _rows(
                lang, part, names, shard[order], list(rank), np.fromiter((docs[t] for t in rank), np.int64, len(rank)),
                np.bincount(at, minlength=len(rank)), src[by_term], tf[by_term],
            )
        self.__init__()


def spill_runs(docs: DataFrame, shards: int, parts: int) -> DataFrame:
    """``RUN`` rows: the slice of one run in one shard. ``part`` is the group of runs that merge first."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block = TaskContext.get().partitionId() % parts, Block()
        for b in batches:
            for lang, source, text in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                block.add(lang, source, text)
                if block.size >= BLOCK:
                    yield from block.spill(shards, part)
        yield from block.spill(shards, part)

    return rows.mapInArrow(run, RUN)


def merge(runs: pa.Table, least: int, part: int) -> Iterator[pa.RecordBatch]:
    """The runs of one shard as one: a heap hands out their terms in order, postings of equal terms and sources add up. Terms in fewer than ``least`` documents go."""
    column = {c: runs.column(c).combine_chunks() for c in ("names", "terms", "docs", "posts", "src", "tf")}
    lists = column["terms"].to_pylist()
    names = sorted({n for row in column["names"].to_pylist() for n in row})
    number = {n: i for i, n in enumerate(names)}
    sizes = np.array([len(x) for x in lists])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    terms: list[bytes] = []
    entry, term_of = np.empty(starts[-1], np.int64), np.empty(starts[-1], np.int64)
    streams = [zip(x, range(s, s + len(x))) for x, s in zip(lists, starts.tolist(), strict=False)]
    for k, (term, e) in enumerate(heapq.merge(*streams)):
        if not terms or terms[-1] != term:
            terms.append(term)
        entry[k], term_of[k] = e, len(terms) - 1
    if not terms:
        return
    docs = np.zeros(len(terms), np.int64)
    np.add.at(docs, term_of, column["docs"].flatten().to_numpy()[entry])
    # Postings of the entries, in merged order.
    posts = column["posts"].flatten().to_numpy().astype(np.int64)
    first = np.concatenate([[0], np.cumsum(posts)])[:-1]
    n = posts[entry]
    at = np.repeat(first[entry] + n - np.cumsum(n), n) + np.arange(n.sum())
    renumber = [[number[x] for x in row] for row in column["names"].to_pylist()]
    per_run = np.array([len(x) for x in column["src"].to_pylist()])
    run_of = np.repeat(np.arange(len(lists)), per_run)
    offset = np.concatenate([[0], np.cumsum([len(x) for x in renumber])])[:-1]
    src = np.concatenate([np.array(x, np.int64) for x in renumber])[offset[run_of] + column["src"].flatten().to_numpy()]
    key = np.repeat(term_of, n) * len(names) + src[at]
    keys, back = np.unique(key, return_inverse=True)
    tf = np.zeros(len(keys), np.int64)
    np.add.at(tf, back, column["tf"].flatten().to_numpy()[at])
    keep = docs >= least
    kept = keep[keys // len(names)]
    keys, tf = keys[kept], tf[kept]
    left = np.flatnonzero(keep)
    if not len(left):
        return
    count = np.bincount(keys // len(names), minlength=len(terms))[left]
    piece = (np.cumsum(count) - count) // ROW  # rows of bounded size
    out = _rows(runs.column("lang")[0].as_py(), part, names, piece, [terms[i] for i in left], docs[left], count, keys % len(names), tf)
    yield out.set_column(1, "shard", pa.array([runs.column("shard")[0].as_py()] * len(out), pa.int32()))


def _merged(least: int):
    def run(runs: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(merge(runs, least, runs.column("part")[0].as_py() // FAN_IN)), _SCHEMA)

    return run


def frequencies(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """``RUN`` rows with every term of a language that ``least`` of its documents hold, whole: all its sources with their counts."""
    tune(docs.sparkSession)
    size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0))).first()[0]
    shards, parts = max(8, -(-size // SHARD_BYTES)), max(1, -(-size // (RUN_BYTES * FAN_IN)))
    out = spill_runs(docs, shards, parts)
    while parts > 1:
        out = out.groupBy("lang", "shard", "part").applyInArrow(_merged(0), RUN)
        parts = -(-parts // FAN_IN)
    return out.groupBy("lang", "shard", "part").applyInArrow(_merged(least), RUN)


def share(count, total, kinds):
    """1 + floor(SCALE * (count + SMOOTHING) / (total + SMOOTHING * kinds)) without a product that overflows."""
    left, whole = np.asarray(count, np.int64) + SMOOTHING, np.asarray(total, np.int64) + SMOOTHING * np.asarray(kinds, np.int64)
    out, left = left // whole, left % whole
    for _ in range(3):
        out, left = out * 1000 + left * 1000 // whole, left * 1000 % whole
    return out + 1


def _totals(found: DataFrame) -> DataFrame:
    """``lang, source, n``: occurrences of kept terms by group, and under source NULL how many terms the language keeps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()
        for b in batches:
            for lang, names, terms, src, tf in zip(*(b.column(c) for c in ("lang", "names", "terms", "src", "tf")), strict=True):
                lang, names, of = lang.as_py(), names.as_py(), np.zeros(len(names), np.int64)
                np.add.at(of, src.values.to_numpy(), tf.values.to_numpy())
                sums[lang, None] += len(terms)
                sums.update({(lang, s): n for s, n in zip(names, of.tolist(), strict=True)})
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in sums], pa.string()), pa.array([k[1] for k in sums], pa.string()), pa.array(list(sums.values()), pa.int64())],
            names=["lang", "source", "n"],
        )

    return found.select("lang", "names", "terms", "src", "tf").mapInArrow(run, "lang string, source string, n long").groupBy("lang", "source").agg(F.sum("n").alias("n"))


def languages(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``lang, sources, n (occurrences by source), kinds``: one row per language, its occurring sources in order of their bytes."""
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    none = F.lit(0).cast("long").alias("n")
    every = docs.select(*names).distinct().select("lang", "source", none).unionByName(_totals(found))
    every = every.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    group = F.when(F.col("source").isNotNull(), F.struct("source", "n"))
    kinds = F.coalesce(F.sum(F.when(F.col("source").isNull(), F.col("n"))), none).alias("kinds")
    out = every.groupBy("lang").agg(F.sort_array(F.collect_list(group)).alias("groups"), kinds)
    return out.select("lang", F.col("groups.source").alias("sources"), F.col("groups.n").alias("n"), "kinds")


def one_sided(src: np.ndarray, p: np.ndarray, zero: np.ndarray, rows: range) -> np.ndarray:
    """For each source of ``rows`` and each other h: the sum over its terms of abs(p - zero of h) less abs(its zero - zero of h)."""
    out = np.zeros((len(rows), len(zero)), np.int64)
    order = np.lexsort((p, src))
    src, p = src[order], p[order]
    bounds = np.searchsorted(src, np.arange(rows.start, rows.stop + 1))
    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        if a == b:
            continue
        mine, sums = p[a:b], np.concatenate([[0], np.cumsum(p[a:b])])
        below = np.searchsorted(mine, zero)
        distance = zero * below - sums[below] + (sums[-1] - sums[below]) - zero * (b - a - below)
        out[i] = distance - (b - a) * np.abs(zero[rows.start + i] - zero)
    return out


def both_sided(term: np.ndarray, src: np.ndarray, p: np.ndarray, zero: np.ndarray, rows: range) -> np.ndarray:
    """For pairs (g in ``rows``, h): the sum over terms that both have of what the one-sided corrections leave. Postings are in order of term."""
    out = np.zeros(len(rows) * len(zero), np.int64)
    step = 1
    while step < len(term):
        at = np.flatnonzero(term[step:] == term[:-step])
        if not len(at):
            break
        for g, h in ((at, at + step), (at + step, at)):
            mine = (src[g] >= rows.start) & (src[g] < rows.stop)
            g, h = g[mine], h[mine]
            zg, zh = zero[src[g]], zero[src[h]]
            value = np.abs(p[g] - p[h]) - np.abs(p[g] - zh) - np.abs(p[h] - zg) + np.abs(zg - zh)
            np.add.at(out, (src[g] - rows.start) * len(zero) + src[h], value)
        step += 1
    return out.reshape(len(rows), len(zero))


_PARTIAL = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections of pairs, and the best terms of each group, of the frequencies in one task."""
    sums: dict[tuple[str, int, str], tuple[list[str], np.ndarray]] = {}
    best: dict[str, tuple[list[str], list[list[tuple[int, bytes]]]]] = {}
    for b in batches:
        for row in range(b.num_rows):
            get = lambda c: b.column(b.schema.get_field_index(c))[row]  # noqa: E731, B023
            lang, sources, kinds = get("lang").as_py(), get("sources").as_py(), get("kinds").as_py()
            total = get("n").values.to_numpy()
            zero = share(np.zeros(len(sources), np.int64), total, kinds)
            number = {s: i for i, s in enumerate(sources)}
            src = np.array([number[s] for s in get("names").as_py()], np.int64)[get("src").values.to_numpy()]
            tf, posts = get("tf").values.to_numpy(), get("posts").values.to_numpy()
            term = np.repeat(np.arange(len(posts)), posts)
            p = share(tf, total[src], kinds)
            wide = max(1, CELLS // len(sources))
            for low in range(0, len(sources), wide):
                rows = range(low, min(len(sources), low + wide))
                for name, part in (("one", one_sided(src, p, zero, rows)), ("two", both_sided(term, src, p, zero, rows))):
                    held = sums.get((lang, low, name))
                    sums[lang, low, name] = (sources, part if held is None else held[1] + part)
                if sum(x[1].size for x in sums.values()) > 4 * CELLS:
                    yield from _flush(sums)
            whole = np.zeros(len(posts), np.int64)
            np.add.at(whole, term, tf)
            more = p - share(whole, total.sum(), kinds)[term]
            terms = get("terms").as_py()
            own = best.setdefault(lang, (sources, [[] for _ in sources]))[1]
            up = np.flatnonzero(more > 0)
            up = up[np.lexsort((term[up], -more[up], src[up]))]  # terms of a row are in order
            start = np.searchsorted(src[up], np.arange(len(sources) + 1))
            for g in np.unique(src[up]).tolist():
                top = up[start[g] : start[g + 1]][:TOP]
                own[g] = sorted(own[g] + [(-int(more[i]), terms[term[i]]) for i in top])[:TOP]
    yield from _flush(sums)
    for lang, (sources, own) in best.items():
        flat = [(s, t, -f) for s, mine in zip(sources, own, strict=True) for f, t in mine]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(flat), pa.string()), pa.array([x[0] for x in flat], pa.string()), pa.array(["term"] * len(flat), pa.string()),
             pa.array([x[1].decode() for x in flat], pa.string()), pa.array([x[2] for x in flat], pa.int64())], schema=_PARTIAL,
        )


def _flush(sums: dict) -> Iterator[pa.RecordBatch]:
    """One-sided corrections count for a pair in both directions, two-sided ones stand there in both already."""
    for (lang, low, name), (sources, m) in sums.items():
        g, h = np.nonzero(m)
        value, g = m[g, h], g + low
        for a, b in ((g, h), (h, g)) if name == "one" else ((g, h),):
            other = a != b
            n = int(other.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * n, pa.string()), pa.array([sources[i] for i in a[other]], pa.string()), pa.array(["pair"] * n, pa.string()),
                 pa.array([sources[i] for i in b[other]], pa.string()), pa.array(value[other], pa.int64())], schema=_PARTIAL,
            )
    sums.clear()


def _bases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For one group each: its difference from every other source of the language if neither had any term."""
    for b in batches:
        for lang, source, at, sources, n, kinds in zip(*(b.column(i) for i in range(6)), strict=True):
            names, at, kinds = sources.as_py(), at.as_py(), kinds.as_py()
            zero = share(np.zeros(len(names), np.int64), n.values.to_numpy(), kinds) if kinds else np.zeros(len(names), np.int64)
            value, other = kinds * np.abs(zero - zero[at]), [i for i in range(len(names)) if i != at]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang.as_py()] * len(other), pa.string()), pa.array([source.as_py()] * len(other), pa.string()),
                 pa.array(["pair"] * len(other), pa.string()), pa.array([names[i] for i in other], pa.string()), pa.array(value[other], pa.int64())],
                schema=_PARTIAL,
            )


def audit(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far each other source of the language is, and what sets the source apart from the language."""
    found = stored(frequencies(docs, least), "frequencies")
    langs = stored(languages(docs, found), "languages")
    partial = "lang string, source string, part string, item string, value long"
    met = found.drop("shard", "part", "docs").join(langs, "lang")
    made = stored(met.mapInArrow(_corrections, partial), "corrections")
    one = langs.select("lang", F.posexplode("sources").alias("at", "source"), "sources", "n", "kinds").select("lang", "source", "at", "sources", "n", "kinds")
    pairs = one.mapInArrow(_bases, partial).unionByName(made.where("part = 'pair'")).groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    place = F.row_number().over(W.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")).alias("rank")
    terms = made.where("part = 'term'").select("*", place).where(F.col("rank") <= TOP)
    return pairs.select("*", place).unionByName(terms)
