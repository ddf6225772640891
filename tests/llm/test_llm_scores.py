"""Context mixing against a plain version that codes one bit after the other."""

import ctypes
import math
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import EMPTY, odd_docs
from pyspark.sql import functions as F

from dotreef.llm import context_mixing as cm
from dotreef.llm.common import documents

MEDIUM = "/root/testdata/sf0.1"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def is_held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def brute_base(rows):
    count = Counter(w for r in rows if not is_held(r["doc_id"]) for w in [*words_of(r["text"]), ""])
    n, v, out = sum(count.values()), len(count), []
    for r in rows:
        tokens = [*words_of(r["text"]), ""]
        out.append((r["doc_id"], is_held(r["doc_id"]), len(tokens), sum(count[w] > 0 for w in tokens), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens)))
    return out


def rows_of(df):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got = df.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score").collect()
    return sorted((tuple(r) for r in got), key=key), key


def base_agrees(spark, docs):
    scored = cm.score(docs)
    got, key = rows_of(scored)
    want = sorted(brute_base([r.asDict() for r in docs.collect()]), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in scored.collect())


def test_base_of_awkward_rows(spark):
    base_agrees(spark, odd_docs(spark))
    assert cm.score(EMPTY(spark)).count() == 0
    held = next(i for i in range(100) if is_held(i))
    alone = spark.createDataFrame([(held, "a b\x0bc\x1cd A", "x"), (held, None, "y")], "doc_id long, text string, token string")
    base_agrees(spark, alone)


def plain(text, model, count):
    """Natural log of the probability of a text, bit by bit."""
    mixer, u32 = model.mixer, 0xFFFFFFFF

    def hashed(h, node, bits):
        h = ((h ^ (node * 0x85EBCA6B & u32)) * 0x9E3779B1) & u32
        return ((h ^ h >> 15) * 0xC2B2AE35 & u32) >> (32 - bits)

    weights, own, met = mixer.weights.astype(float).copy(), defaultdict(lambda: [cm.PRIOR, cm.PRIOR]), np.zeros(cm.GATES)
    waiting, at_step, total = [], 0, 0.0

    def bit(b, node, y, one, contexts):
        slots = [one << cm.CLASS_BITS | node, *[hashed(h & u32, node, cm.HASH_BITS) for h in contexts]]
        x = [float(o[s]) for o, s in zip(mixer.odds, slots, strict=True)] + [math.log(own[node][1] / own[node][0])]
        gate = b * 4 + int(mixer.bucket[slots[1]])
        z = sum(float(w) * v for w, v in zip(weights[:, gate], x, strict=True))
        p = 1 / (1 + math.exp(-z))
        waiting.append((gate, node, y, [(y - p) * v for v in x]))
        return math.log(p if y else 1 - p)

    def refine():
        slope, bits = defaultdict(lambda: np.zeros(cm.INPUTS)), Counter()
        for gate, node, y, g in waiting:
            slope[gate] += g
            bits[gate] += 1
            own[node][y] += 1
        for gate, g in slope.items():
            met[gate] += bits[gate]
            weights[:, gate] += cm.OWN_RATE * g / (met[gate] + 64)
        waiting.clear()

    tokens = [*words_of(text), ""]
    follows, again = {}, []
    doc_words = defaultdict(set)
    asked = repeated = 0
    crc = lambda w: zlib.crc32(w.encode())
    for i, word in enumerate(tokens):
        step = int(math.log2(i // cm.STEP + 1))
        if step != at_step:
            refine()
            at_step = step
        before = tokens[i - 1] if i else None
        guess = follows.get(before)
        follows[before] = word
        one, two = cm._class(tokens[i - 1]) if i else 0, cm._class(tokens[i - 2]) if i > 1 else 0
        run = (again[i - 1] if i else 0) + 2 * (again[i - 2] if i > 1 else 0)
        again.append(int(guess == word))
        if guess is not None:
            total += bit(0, 0, again[i], run, [cm._class(guess) * 269 + run + (1 << 20), crc(guess) ^ run])
            if again[i]:
                continue
        kind = cm._class(word)
        for b in range(cm.CLASS_BITS):
            node = (1 << b) + (kind >> (cm.CLASS_BITS - b))
            total += bit(b + 1, node, kind >> (cm.CLASS_BITS - 1 - b) & 1, one, [one * 257 + two + 1, crc(tokens[i - 1]) if i else 0])
        if not word:
            continue
        fresh = (model.single[kind] + 1) / (model.tokens[kind] + 2)
        if count[word]:
            total += math.log(count[word] / model.tokens[kind]) + math.log1p(-fresh)
            continue
        total += math.log(fresh)
        mine = doc_words[kind]
        if mine:
            p = (repeated + 0.5) / (asked + 1)
            asked += 1
            if word in mine:
                repeated += 1
                total += math.log(p / len(mine))
                continue
            total += math.log1p(-p)
        mine.add(word)
        total += float(model.speller.cost([word])[0])
    return total


@pytest.fixture(scope="module")
def small(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    lines = [(900 + i, "Boiler plate line here. " * (i % 4) + f"tail{i} zzqx zzqx {'zzqx ' * i}", "en", "s", 1) for i in range(40)]
    return docs.unionByName(spark.createDataFrame(lines, "doc_id long, text string, lang string, source string, n_chars long"))


def test_score_against_bit_by_bit_coding(spark, small):
    rows = small.select("doc_id", cm.held_out(F.col("doc_id")).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    model, tokens = cm.fit(rows, rows.agg(F.sum(F.octet_length("text"))).first()[0])
    count = Counter({r["token"]: r["count"] for r in tokens.collect()})
    got = {r["doc_id"]: r for r in cm.score(small).collect()}
    texts = {r["doc_id"]: r["text"] for r in rows.collect()}
    assert set(got) == set(texts)
    for i, text in list(texts.items())[:60] + [(i, t) for i, t in texts.items() if i >= 900]:
        want = plain(text, model, count) / math.log(10)
        assert got[i]["score"] == pytest.approx(want, rel=2e-4, abs=1e-3), i
        if text:
            assert got[i]["bits_per_byte"] == pytest.approx(-got[i]["score"] / math.log10(2) / len(text.encode()))


def test_words_are_hashed_together_as_one_by_one():
    """Classes and checksums of many words at once: the end, one and two bytes, several bytes a character, words longer than what is hashed together, a cut array."""
    rng = np.random.default_rng(7)
    words = ["", "a", "ab", "é", "ßü", "日本語", "x" * 64, "y" * 65, "z" * 300, *["".join(rng.choice(list("abcdeé日"), n)) for n in rng.integers(1, 90, 500)]]
    for some in (pa.array(words), pa.array(["cut", *words, "off"]).slice(1, len(words)), pa.array([""]), pa.array([], pa.string())):
        assert cm._classes(some).tolist() == [cm._class(w) for w in some.to_pylist()]
        assert cm._hashes(some).tolist() == [zlib.crc32(w.encode()) for w in some.to_pylist()]


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="the allocator has no such call")
def test_what_a_batch_took_is_given_back():
    """Arrays that are gone leave no memory with the worker, though a few between them are still in use."""
    held = lambda: int(re.search(r"^Pss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text(), re.M)[1])
    left = cm._batches(iter([pa.RecordBatch.from_pydict({"text": ["a"]})]), 1)
    next(left)
    arrays = [np.ones(8_000) for _ in range(2_000)]  # 128 MB
    kept, before = arrays[::50], held()
    del arrays
    assert list(left) == [] and len(kept) == 40
    assert held() < before - 64 * 1024


def test_evidence_of_many_bits_is_that_of_single_ones():
    """Slope and curvature of more bits than are added up at once, against a sum bit by bit; zeros and ones counted in the same way."""
    rng = np.random.default_rng(8)
    n = 2 * cm.EVIDENCE + 5
    x, y, bucket = [rng.normal(size=n).astype(np.float32) for _ in range(3)], rng.random(n) < 0.3, rng.choice([0, 1, 3], n).astype(np.uint8)
    weights, found = rng.normal(size=(3, cm.BUCKETS)).astype(np.float32), np.zeros((4, 3, cm.BUCKETS))
    cm._evidence(x, y, bucket, weights, found)
    want, v = np.zeros_like(found), np.array(x, float)
    for k in range(cm.BUCKETS):
        u = v[:, bucket == k]
        p = 1 / (1 + np.exp(-(weights[:, k].astype(float) @ u)))
        want[0, :, k], want[1:, :, k] = u @ (y[bucket == k] - p), np.einsum("in,jn,n->ij", u, u, p * (1 - p))
    assert np.allclose(found, want) and not found[:, :, 2].any()
    place = rng.integers(0, 50, n)
    zeros, ones = cm._zeros_and_ones(2 * place + y, 50)
    assert zeros.tolist() == np.bincount(place[~y], minlength=50).tolist() and ones.tolist() == np.bincount(place[y], minlength=50).tolist()


def test_decisions_are_a_distribution():
    rng = np.random.default_rng(1)
    mixer = cm.Mixer(rng.integers(0, 9, cm.TABLE), rng.integers(0, 9, cm.TABLE))
    word = [next(w for k in range(10**6) if cm._class(w := f"w{k}") == c) for c in range(1, 40)]
    some = pa.array([f"start of it {w}" for w in word])
    t = cm.Tokens.of(some)
    d = cm.Decisions.of(t)
    # The fourth token's class bits, as one sum over all classes, by replacing the class itself.
    at = t.starts + 3
    total = 0.0
    for c in range(cm.CLASSES):
        d.cls[at] = c
        log = np.zeros(len(t.sizes))
        for b, who, node, y, slots in cm._bits(d, at):
            if len(who):
                x = [o[s] for o, s in zip(mixer.odds, slots, strict=True)] + [np.zeros(len(who))]
                gate = mixer._gate(b, slots)
                log += cm._outcome(sum(w[gate] * v for w, v in zip(mixer.weights, x, strict=True)), y)[0]
        total += math.exp(log[0])
    assert total == pytest.approx(1, rel=1e-5)
    model = cm.Model(mixer, None, np.array([3, 10]), np.array([1, 4]), np.array([0, 2]))
    counts = np.array([4, 3, 2, 1])
    inside = model.within(np.zeros(4, int), np.arange(4), [None] * 4, np.ones(4, int), counts)
    assert np.exp(inside).sum() + (2 + 1) / (10 + 2) == pytest.approx(1)


def test_held_out_texts_teach_nothing(spark):
    rows = [(i, f"common words and {'pears' if i % 2 else 'plums'} number {i}") for i in range(120)]
    other = [(i, "altogether different" if is_held(i) else t) for i, t in rows]
    one, two = ({r["doc_id"]: (r["score"], r["base_score"]) for r in cm.score(spark.createDataFrame(x, "doc_id long, text string")).collect()} for x in (rows, other))
    assert any(is_held(i) for i, _ in rows)
    assert all(one[i] == two[i] for i, _ in rows if not is_held(i))


def test_partitions_do_not_matter(spark, small):
    one, two = ({r["doc_id"]: r["score"] for r in cm.score(small.repartition(n)).collect()} for n in (1, 5))
    assert one.keys() == two.keys() and np.allclose([one[i] for i in one], [two[i] for i in one], rtol=1e-6)


def test_held_out_scores_beat_the_base(spark):
    rows = cm.score(documents(spark, MEDIUM)).groupBy("held_out").agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).collect()
    assert len(rows) == 2 and all(r["score"] > r["base"] for r in rows)


def test_weights_come_from_every_text(spark):
    """No text and no word is too long or too many to teach the starting weights."""
    rows = spark.range(3000).select(F.concat_ws(" ", F.lit("some words of"), F.expr("concat('w', id)"), F.expr("repeat('again and again ', id % 7)")).alias("text"), F.lit(False).alias("held_out"))
    long = spark.range(1).select(F.repeat(F.lit("on and on it goes "), 70_000).alias("text"), F.lit(False).alias("held_out"))
    size = lambda df: df.agg(F.sum(F.octet_length("text"))).first()[0]
    model, tokens = cm.fit(rows.union(long), size(rows.union(long)))
    texts = [r["text"] for r in rows.union(long).collect()]
    zeros, ones = cm._dense(cm.statistics(rows.union(long), 1).where("token IS NULL"), cm.TABLE)
    mixer, odds = cm.Mixer(zeros, ones), cm._others(zeros, ones, cm.SIZES)
    found = np.zeros((cm.INPUTS + 1, cm.INPUTS, cm.GATES))
    for text in texts:
        t = cm.Tokens.of(pa.array([text]))
        mixer.evidence(t, cm.Decisions.of(t), odds, found)
    asked = sum(int(cm.Decisions.of(cm.Tokens.of(pa.array([x]))).asked.sum()) for x in texts)
    assert asked > 300_000 and np.allclose(cm._moved(mixer.weights, found), model.mixer.weights, atol=1e-4)
    once = [r["token"] for r in tokens.where("count = 1").collect()]
    spelled = np.zeros((len(cm.SPELL_SIZES) + 1, len(cm.SPELL_SIZES), 8 * cm.BUCKETS))
    tables = np.zeros((2, cm.SPELL_TABLE), np.int64)
    cm._add(cm._spelled(once), cm.SPELL_SIZES, *tables)
    speller = cm.Speller(*tables)
    speller.evidence(once, cm._others(*tables, cm.SPELL_SIZES), spelled)
    assert len(once) == 3000 and np.allclose(cm._moved(speller.weights, spelled), model.speller.weights, atol=1e-6)
