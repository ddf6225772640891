"""Operators that bring rows together: packing, sharding, exact and near dedup, repeats, vectors."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from llm_rows import EMPTY, odd_docs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dotreef.llm import exact_dedup, near_dedup, packing, repeats, sharding, vector_links
from dotreef.llm.common import components

RANKS = P.path("byte_bpe_50k.tiktoken")


def check_packing(rows, want, window):
    """``want``: bag of id lists of the documents."""
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append(r)
        assert 0 < r["length"] <= window and len(r["ids"]) == 4 * r["length"]
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
    parts = defaultdict(list)
    for r in rows:
        parts[r["doc_id"], r["doc_tokens"]].append((r["start"], r["ids"]))
    made = Counter()
    for own in parts.values():
        # Repeated rows have the same starts: one document takes one piece of each.
        by = defaultdict(list)
        for start, ids in own:
            by[start].append(bytes(ids))
        for k in range(len(by[0])):
            made[tuple(np.frombuffer(b"".join(by[s][k] for s in sorted(by)), "<u4").tolist())] += 1
    assert made == want
    return sequences


def test_packing_round_trip(spark):
    docs = odd_docs(spark)
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    want = Counter((*t.encode(r["text"] or "", add_special_tokens=False).ids, 1) for r in docs.collect())
    for path in (RANKS, P.path("byte_bpe_50k.json")):
        check_packing(packing.pack(docs, path, window=64).collect(), want, 64)
    assert packing.pack(EMPTY(spark), RANKS).count() == 0


def test_packing_gives_added_tokens_their_ids(spark):
    end, rng = "<|endoftext|>", random.Random(6)
    texts = [end, f"a  {end}  b", end * 3, f"x{end}y", end[:-1], f"it'{end}s"]
    texts += ["".join(rng.choices([end, "<|", "|>", " ", "  ", "\n", "ab", "'s", "é", "12", "漢"], k=rng.randint(1, 30))) for _ in range(300)]
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert want[0] == [50256]
    for path in (RANKS, P.path("byte_bpe_50k.json")):
        assert [packing.encoder(path)(x) for x in texts] == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check_packing(packing.pack(docs, RANKS, window=64).collect(), Counter((*ids, 1) for ids in want), 64)


def test_packing_leaves_little_room(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.pack(docs, RANKS).select("sequence_id", "length").groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    total = sum(r["n"] for r in rows)
    assert 2048 * len(rows) - total <= 0.01 * total


def test_best_fit_takes_the_tightest_window():
    rng = random.Random(2)
    for _ in range(200):
        lengths = sorted((rng.randint(1, 50) for _ in range(rng.randint(0, 80))), reverse=True)
        where, offsets = packing.best_fit(lengths, 50)
        fill: list[int] = []
        for n, w, at in zip(lengths, where, offsets, strict=True):
            fits = [50 - f for f in fill if 50 - f >= n]
            if not fits:
                assert w == len(fill) and at == 0
                fill.append(0)
            else:
                assert 50 - fill[w] == min(fits) and at == fill[w]
            fill[w] += n


def test_sharding_rows_law(spark):
    docs = odd_docs(spark)
    rows = sharding.assign(docs, shards=4).collect()
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[s]) for s in range(4)]
    assert max(counts) - min(counts) <= 1
    assert sharding.assign(EMPTY(spark)).count() == 0


def test_sharding_moves_little_with_slack(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    old = {r["doc_id"]: r["shard"] for r in sharding.assign(docs, shards=8, slack=0.1).collect()}
    new = {r["doc_id"]: r["shard"] for r in sharding.assign(docs, shards=9, slack=0.1).collect()}
    assert max(Counter(old.values()).values()) <= 1.1 * 20_000 / 8 + 1
    assert sum(old[i] != new[i] for i in old) < 0.3 * len(old)  # a fresh hash would move 89 in 100


def test_parts_fill_every_place():
    rng = random.Random(4)
    for _ in range(100):
        shards = rng.randint(1, 6)
        _, owner = sharding.ring(shards, 5)
        counts = {a: rng.choice([0, 0, 1, 9, 100]) for a in range(len(owner))}
        out = sharding.parts(counts, owner, sharding.bounds(sum(counts.values()), shards, 0.0))
        for a, n in counts.items():
            assert sorted(x for arc, low, high, *_ in out if arc == a for x in range(low, high)) == list(range(n))


def weak(text):
    return F.substring(F.unhex(F.sha2(F.substring(text, 1, 5), 256)), 1, 1)


@pytest.mark.parametrize("digest", [exact_dedup.sha256, weak])
def test_exact_dedup_by_hand(spark, digest):
    docs = odd_docs(spark)
    groups = defaultdict(list)
    for r in docs.collect():
        groups[r["text"] or ""].append(r["doc_id"])
    rows = exact_dedup.assign(docs, digest).collect()
    key = lambda i: (i is not None, i)
    want = Counter((i, max(ids, key=key), len(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows) == want
    assert Counter(r["text_sha256"] for r in rows if r["kept"]) == Counter({hashlib.sha256(t.encode()).hexdigest(): 1 for t in groups})
    assert all(r["doc_id"] == r["keep_id"] for r in rows if r["kept"])


def test_exact_dedup_keeps_rows_whole(spark):
    docs = odd_docs(spark)
    out = exact_dedup.keep_one(docs)
    assert out.columns == docs.columns
    assert Counter(r["text"] or "" for r in out.collect()) == Counter({r["text"] or "": 1 for r in docs.collect()})
    assert exact_dedup.assign(EMPTY(spark)).count() == exact_dedup.keep_one(EMPTY(spark)).count() == 0


def test_exact_dedup_plan_has_no_python(spark):
    plan = exact_dedup.assign(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def roots(nodes, links):
    top = {n: n for n in nodes}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        top[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(9)
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    more = [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    links = chain + star + more + star + [(5, 5)]
    nodes = {x for a, b in links if a != b for x in (a, b)}
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == roots(nodes, links)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_rows(spark):
    rng = random.Random(21)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    rows = []
    for base in range(12):
        text = [word() for _ in range(rng.randint(30, 200))]
        for _ in range(rng.randint(1, 12)):
            own = list(text)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = word()
            rows.append((len(rows), " ".join(own)))
    rows += [(len(rows) + i, t) for i, t in enumerate(["a b", "a  B", "", None, "!!", "the the the the the the", "the " * 40, "the " * 44])]
    return rows


@pytest.mark.parametrize("block", [400, 5])
def test_near_dedup_by_hand(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = near_rows(spark)
    bags = {i: near_dedup.bag(t or "") for i, t in rows}
    links = [(i, j) for i in bags for j in bags if i < j and len(bags[i][0]) and near_dedup.overlap(bags[i], bags[j]) >= 0.8]
    want = roots(bags, links)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.group(docs).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == want
    assert {r["doc_id"] for r in got if r["kept"]} == set(want.values())


def test_near_dedup_awkward_rows(spark):
    docs = odd_docs(spark)
    out = near_dedup.keep_one(docs)
    assert out.columns == docs.columns
    kept = Counter(r["text"] for r in out.collect())
    assert kept["alpha beta gamma delta epsilon zeta"] == 1 and kept[None] == 2 and kept[""] == 1
    assert sum("lorem" in (t or "") for t in kept.elements()) == 1
    assert near_dedup.group(EMPTY(spark)).count() == near_dedup.keep_one(EMPTY(spark)).count() == 0


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    for _ in range(4):
        keys = near_dedup.mix(rng.integers(1, 1 << 60, 60).astype("uint64"))
        a, b = (keys[:45], rng.integers(1, 9, 45)), (keys[15:], rng.integers(1, 9, 45))
        a, b = ((np.sort(k), w[np.argsort(k)]) for k, w in (a, b))
        x, y = near_dedup.signatures([a, b], 4000)
        assert abs((x == y).mean() - near_dedup.overlap(a, b)) < 0.04
    assert np.isinf(near_dedup.signatures([(np.empty(0, "uint64"), np.empty(0, int))], 8)).all()


def removed_by_hand(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        hit = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                hit[i : i + length] = b"\1" * length
        out.append((len(t), sum(hit), len([r for r in bytes(hit).split(b"\0") if r]), bytes(c for c, h in zip(t, hit, strict=True) if not h)))
    return Counter(out)


@pytest.mark.parametrize("length", [16, 40])
def test_repeats_by_hand(spark, length):
    rng = random.Random(length)
    passage = ["".join(rng.choices("abcdeé ", k=rng.randint(length - 4, 4 * length))) for _ in range(8)]
    texts = ["", "x" * length, "y" * (3 * length), "z" * (length - 1), "ab" * length, "ba" * length]
    for _ in range(60):
        own = "".join(rng.choice([rng.choice(passage), "".join(rng.choices("abcdefg", k=rng.randint(1, 60)))]) for _ in range(rng.randint(1, 6)))
        texts.append(own[rng.randint(0, 10) :])
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, texts[9]), (3, None)], "doc_id long, text string")
    rows = repeats.remove(docs, length).collect()
    want = removed_by_hand([(r["text"] or "").encode() for r in docs.collect()], length)
    assert Counter((r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in rows) == want


def test_repeats_in_segments(spark, monkeypatch):
    rng = random.Random(8)
    part = "".join(rng.choices("abcdefgh", k=300))
    text = "".join(rng.choices("abcdefgh", k=500)) + part + "".join(rng.choices("abcdefgh", k=400)) + part
    segments = list(repeats._segments(1000, 16))
    assert segments[0] == (0, 1000)
    monkeypatch.setattr(repeats, "SEGMENT", 100)
    assert list(repeats._segments(230, 16)) == [(0, 115), (100, 215), (200, 230)]
    rows = repeats.remove(spark.createDataFrame([(1, text), (2, part)], "doc_id long, text string"), 40).collect()
    assert Counter((r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in rows) == removed_by_hand([text.encode(), part.encode()], 40)


def test_repeats_awkward_rows(spark):
    docs = odd_docs(spark)
    rows = repeats.digests(docs, 400).collect()
    assert len(rows) == docs.count()
    assert {r["n_removed"] for r in rows if r["doc_id"] in (7, 8)} == {len(odd_docs(spark).where("doc_id = 7").first()["text"])}
    assert repeats.remove(EMPTY(spark)).count() == 0


def vectors(spark):
    rng = np.random.default_rng(12)
    rows = []
    for label in (0, 1, 2):
        for _ in range(60):
            centre = rng.standard_normal(16)
            for _ in range(rng.integers(1, 6)):
                rows.append((len(rows), (centre + rng.standard_normal(16) * 0.15).astype("float32").tolist(), label))
        centre = rng.standard_normal(16)
        rows += [(len(rows) + k, (centre + rng.standard_normal(16) * 0.03).tolist(), label) for k in range(80)]
    same = rows[0][1]
    rows += [(len(rows) + k, same, 0) for k in range(50)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]]
    rows += [(len(rows) + k, v, 0) for k, v in enumerate(odd)]
    rows += [(len(rows), same, None), (len(rows) + 1, [v * 2 for v in same], 0)]
    return rows


@pytest.mark.parametrize("block", [1024, 40])
def test_vector_links_by_hand(spark, block):
    rows = vectors(spark)
    good = {}
    for i, v, label in rows:
        if v and label is not None and None not in v and np.isfinite(v).all() and np.any(v):
            good[i] = (len(v), label, np.array(np.array(v, "float32"), float))
    links = []
    for i, (n, label, v) in good.items():
        for j, (m, other, w) in good.items():
            if i < j and n == m and label == other and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.93:
                links.append((i, j))
    top = roots([i for i, *_ in rows], links)
    degree = Counter(x for pair in links for x in pair)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("cid", F.lit("x"))
    got = {r["vec_id"]: r for r in vector_links.link(frame, leaf=32, block=block).collect()}
    assert len(got) == len(rows)
    assert {i: r["component_id"] for i, r in got.items()} == top
    assert {i: r["n_links"] for i, r in got.items()} == {i: degree[i] for i in got}
    assert all(r["kept"] == (i == top[i]) for i, r in got.items())


def test_vector_links_empty(spark):
    assert vector_links.link(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_repeats_of_strings_that_sums_confuse(spark):
    """Strings whose polynomial sums modulo a power of two agree are still told apart."""
    tm = "a"
    while len(tm) < 2048:
        tm += tm.translate(str.maketrans("ab", "ba"))
    texts = [tm[:1024], tm[:1024].translate(str.maketrans("ab", "ba")), tm[300:1500], "c" + tm[5:900], tm[:512] + "c" + tm[512:1024]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for length in (256, 400):
        rows = repeats.remove(docs, length).collect()
        want = removed_by_hand([t.encode() for t in texts], length)
        assert Counter((r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in rows) == want


def test_repeats_in_a_long_text(spark):
    """A text of many segments: repeats in itself, far apart, and a stretch that is repeated in part."""
    rng = random.Random(3)
    fresh = lambda n: rng.randbytes(n // 2).hex()
    passage = fresh(5000)
    parts = [fresh(2_000_000), "|" + passage + "|", fresh(1_500_000), "<" + passage + ">", fresh(900_001), "(" + passage[700:2200] + ")", fresh(50_000)]
    docs = spark.createDataFrame([(1, "".join(parts)), (2, "[" + passage[1000:1399] + "]"), (3, "{" + passage[1000:1400] + "}")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in repeats.remove(docs, 400).collect()}
    at = [len("".join(parts[:k])) + 1 for k in (1, 3, 5)]
    assert [(s["start"], s["end"]) for s in rows[1]["spans"]] == [(at[0], at[0] + 5000), (at[1], at[1] + 5000), (at[2], at[2] + 1500)]
    assert rows[2]["n_removed"] == 0 and rows[3]["n_removed"] == 400 and bytes(rows[3]["kept"]) == b"{}"
    assert bytes(rows[1]["kept"]).decode() == "".join([parts[0], "||", parts[2], "<>", parts[4], "()", parts[6]])


@pytest.mark.parametrize("taken", [("_place_of_row",), ("_metadata",), ("_PLACE_OF_ROW", "_place_of_row_", "_metadata")])
def test_columns_with_the_names_of_hidden_ones(spark, tmp_path, taken):
    rows = [(i, t, *["mine"] * len(taken)) for i, t in enumerate(["same text", "same text", "other", None, "x" * 900, "y" + "x" * 450])]
    made = spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", *[f"{c} string" for c in taken]]))
    made.write.parquet(str(tmp_path / "docs"))
    for docs in (made, spark.read.parquet(str(tmp_path / "docs"))):
        assert [r["kept"] for r in sorted(exact_dedup.assign(docs).collect(), key=lambda r: r["doc_id"])] == [False, True, True, True, True, True]
        assert exact_dedup.keep_one(docs).columns == docs.columns == near_dedup.keep_one(docs).columns
        assert sorted(r["doc_id"] for r in near_dedup.keep_one(docs).collect()) == [0, 2, 3, 4, 5]
        assert {r["doc_id"]: r["n_removed"] for r in repeats.digests(docs, 400).collect()} == {0: 0, 1: 0, 2: 0, 3: 0, 4: 900, 5: 450}


def passages_by_hand(texts, length):
    """Words of each text that a string of ``length`` words covers which stands in another text as well."""
    worded = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for t in texts]
    seen = {}
    for i, words in enumerate(worded):
        for k in range(len(words) - length + 1):
            seen.setdefault(tuple(words[k : k + length]), set()).add(i)
    out = []
    for words in worded:
        hit = bytearray(len(words))
        for k in range(len(words) - length + 1):
            if len(seen[tuple(words[k : k + length])]) > 1:
                hit[k : k + length] = b"\1" * length
        out.append([m.span() for m in re.finditer(b"\1+", bytes(hit))])
    return out


def test_passages_by_hand(spark, monkeypatch):
    rng = random.Random(50)
    some = ["a", "Bé", "c3", "漢字", "dd"]
    for length, segment in ((50, 1 << 19), (12, 1 << 19), (12, 240)):
        monkeypatch.setattr(repeats, "SEGMENT", segment)
        shared = [" ".join(rng.choices(some, k=rng.randint(length - 3, 3 * length))) for _ in range(8)]
        texts = ["", "?!", "x " * (3 * length), "x, " * (length - 1), "y " * length, "z\n" * (2 * length)]
        for _ in range(40):
            parts = [rng.choice([rng.choice(shared), " ".join(rng.choices(some, k=rng.randint(1, 40)))]) for _ in range(rng.randint(1, 7))]
            texts.append(rng.choice([" ", ".", "\n- "]).join(parts))
        texts += [texts[7], texts[8].upper(), "own " + " own ".join([" ".join(f"w{k}" for k in range(2 * length))] * 3), " ".join(f"w{k}" for k in range(5, 5 + length))]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        rows = {r["doc_id"]: [(p["start"], p["end"]) for p in r["passages"]] for r in repeats.digests(docs, 400, length).collect()}
        assert rows == dict(enumerate(passages_by_hand(texts, length)))


def test_a_shared_passage_shorter_than_a_removed_string(spark, tmp_path):
    """52 words of 300 bytes in two documents: nothing is removed, the passage is told; the same words twice in one document are none."""
    from dotreef.llm import queries

    rng = random.Random(52)
    fresh = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    passage, twice = fresh(52), fresh(60)
    texts = [f"{fresh(90)} {passage} {fresh(80)}", f"{fresh(10)}. {passage.upper()}\n{fresh(30)}", f"{twice} {fresh(70)} {twice}", fresh(200), None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in queries.op3_repeats(spark, str(tmp_path)).collect()}
    assert [(r["n_removed"], r["n_spans"]) for _, r in sorted(rows.items())] == [(0, 0)] * 5
    assert [(r["n_passages"], r["n_passage_words"]) for _, r in sorted(rows.items())] == [(1, 52), (1, 52), (0, 0), (0, 0), (0, 0)]
