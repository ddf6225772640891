"""Filter interaction and source divergence against brute force."""

import re
from itertools import permutations

import pytest
from llm_rows import EMPTY, odd_docs

from dotreef.llm import filter_audit, source_divergence

DOCS = "doc_id long, text string, lang string, source string, digest string, mask int, n long, words string"


def brute_audit(docs, labels):
    good, toxic = ({r["doc_id"] for r in labels if r[c] == 1} for c in ("quality", "toxic"))
    rows = []
    for d in docs:
        t, words = d["text"] or "", re.findall(r"[^\x20\x09-\x0D]+", d["text"] or "")
        fails = {"A"} if len(words) < 100 else set()
        fails |= {"B"} if 100 * len(set(words)) < 80 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 10 * len(t) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        same = [e["doc_id"] for e in docs if (e["text"] or "") == t and e["doc_id"] is not None]
        fails |= {"E"} if d["doc_id"] is not None and min(same) < d["doc_id"] else set()
        rows.append((d["lang"] or "", fails, d["doc_id"] in good and d["doc_id"] is not None, d["doc_id"] in toxic and d["doc_id"] is not None))
    out = {}
    for part in {r[0] for r in rows}:
        mine, shapley = [r for r in rows if r[0] == part], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = list(mine)
            for step, f in enumerate(order, 1):
                gone, before = [r for r in left if f in r[1]], left
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in r[1] for r in mine) - sum(f in r[1] for r in before), sum(r[1] == {f} for r in mine),
                    sum(r[2] for r in gone), sum(r[3] for r in gone),
                ]
        for key in out:
            if key[0] == part:
                out[key].append(shapley[key[1][key[2] - 1]])
    return {k: tuple(v) for k, v in out.items()}


COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def found(df):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in COLUMNS) for r in df.collect()}


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, part string, n int")


def test_every_order_against_one_by_one_filtering(spark):
    words = [f"w{i}" for i in range(130)]
    texts = [" ".join(words), " ".join(words) + " #", "A B C " * 60, " ".join(words).upper(), "same again", " ".join(words[:100]), " ".join(words[:99]), "", None,
             "x\x1cy " * 120, "tab\tsep\x0bfeed\x0cend " * 30, "ÄÖÜ " * 200]
    rows = [(i, texts[i % len(texts)], (None, "", "en", "de")[i % 4], None, "d", 1, 2, "w") for i in range(60)]
    rows += [(None, "same again", "en", None, None, None, None, None), (0, texts[0], "en", None, None, None, None, None), (-7, "same again", "de", None, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = labels_of(spark, [(i, i % 2, i % 3 == 0 and 1 or 0, "x", 1) for i in range(0, 60, 2)] + [(4, 1, 1, None, None), (None, 1, 1, None, None), (6, None, None, None, None)])
    want = brute_audit([r.asDict() for r in docs.collect()], labels.collect())
    got = found(filter_audit.audit(docs, labels))
    assert got == want and len(got) == 3 * 600


def test_awkward_rows(spark):
    docs, none = odd_docs(spark), labels_of(spark, [])
    assert found(filter_audit.audit(docs, none)) == brute_audit([r.asDict() for r in docs.collect()], [])
    assert filter_audit.audit(EMPTY(spark), none).count() == 0


def test_one_text_on_a_third_of_all_rows_folds_before_the_exchange(spark):
    rows = [(i, "the same text" if i % 3 == 0 else f"text {i}", "en", "s", None, 0, 0, None) for i in range(3000)]
    counts = {r["mask"]: r["n"] for r in filter_audit.mask_counts(spark.createDataFrame(rows, DOCS), labels_of(spark, [])).collect()}
    assert counts == {0b00001: 2001, 0b10001: 999}


@pytest.mark.parametrize("n", [1, 2, 3])
def test_removal_steps_for_few_filters(n):
    import numpy as np

    orders = np.array(list(permutations(range(n))))
    steps = filter_audit.removal_steps(n, orders)
    for m in range(1 << n):
        for j, o in enumerate(orders):
            assert steps[m, j] == next((s for s, f in enumerate(o, 1) if m >> f & 1), n + 1)


def test_filters_are_a_parameter(spark):
    docs = spark.createDataFrame([(1, "aa", None, None, None, 0, 0, None), (2, "b", None, None, None, 0, 0, None)], DOCS)
    got = found(filter_audit.audit(docs, labels_of(spark, []), {"X": "length(text) > 1"}, "Y"))
    assert got["", "XY", 1][:2] == (1, 1) and got["", "YX", 1][:2] == (2, 0) and len(got) == 4


# --- source divergence ---------------------------------------------------------------------


def brute_divergence(docs, least):
    fold = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = set()
    for lang in {d["lang"] or "" for d in docs}:
        mine = [(d["source"] or "", fold(d["text"])) for d in docs if (d["lang"] or "") == lang]
        held = {}
        for _, words in mine:
            for w in set(words):
                held[w] = held.get(w, 0) + 1
        kept = sorted(w for w, n in held.items() if n >= least)
        groups = sorted({s for s, _ in mine})
        count = {s: dict.fromkeys(kept, 0) for s in groups}
        for s, words in mine:
            for w in words:
                if w in count[s]:
                    count[s][w] += 1
        share = lambda c: {w: 1 + 10**9 * (c[w] + 5) // (sum(c.values()) + 5 * len(kept)) for w in kept}
        p, q = {s: share(count[s]) for s in groups}, share({w: sum(count[s][w] for s in groups) for w in kept})
        for s in groups:
            found = {"pair": [(sum(abs(p[s][w] - p[o][w]) for w in kept), o) for o in groups if o != s],
                     "term": [(p[s][w] - q[w], w) for w in kept if count[s][w] > 0 and p[s][w] > q[w]]}
            for part, rows in found.items():
                rows = sorted(rows, key=lambda r: (-r[0], r[1].encode()))
                out |= {(lang, s, part, item, value, k) for k, (value, item) in enumerate(rows, 1) if part == "pair" or k <= 50}
    return out


def divergence(df):
    rows = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def mixed_docs(spark, n=400):
    import random

    rng = random.Random(7)
    words = [f"w{''.join(rng.choice('abcdeé') for _ in range(rng.randint(1, 4)))}" for _ in range(150)] + ["Straße", "HELLO", "x-y", "漢字", "it's"]
    rows = []
    for i in range(n):
        text = " ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=rng.randint(0, 60)))
        rows.append((i, rng.choice([text, text + "\n#A1b", None if i % 50 == 0 else text]), rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "ß", None, "S1"])))
    rows += [(-1, "", "fr", "empty"), (-2, "123 45", "fr", None), (None, None, None, None), (5, "only here once", "solo", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "1 AS shard", "2 AS part", "'n' AS names", "3L AS n")


def test_divergence_against_brute_force(spark, monkeypatch):
    docs = mixed_docs(spark)
    rows = [r.asDict() for r in docs.collect()]
    for least in (1, 30):
        want = brute_divergence(rows, least)
        assert divergence(source_divergence.audit(docs, least)) == want and any(r[2] == "term" for r in want)
    # Several levels of merging, many shards.
    monkeypatch.setattr(source_divergence, "RUN_BYTES", 1)
    monkeypatch.setattr(source_divergence, "SHARD_BYTES", 500)
    assert divergence(source_divergence.audit(docs.repartition(7), 3)) == brute_divergence(rows, 3)


def test_divergence_of_awkward_rows(spark):
    docs = odd_docs(spark)
    for least in (1, 2, 30):
        assert divergence(source_divergence.audit(docs, least)) == brute_divergence([r.asDict() for r in docs.collect()], least)
    assert source_divergence.audit(EMPTY(spark)).count() == 0


def test_runs_merge_like_one(monkeypatch):
    import pyarrow as pa

    whole, runs = source_divergence.Block(), []
    for i in range(60):
        text = " ".join("t" + chr(97 + (i * k) % 17) for k in range(1, 20))
        whole.add("en", f"s{i % 3}", text)
        block = source_divergence.Block()
        block.add("en", f"s{i % 3}", text)
        runs += block.spill(1, 0)
    for size in (1 << 16, 5):
        monkeypatch.setattr(source_divergence, "ROW", size)
        out = pa.Table.from_batches(list(source_divergence.merge(pa.Table.from_batches(runs), 2, 0))).to_pylist()
        assert (len(out) > 1) == (size == 5)
        got = {}
        for row in out:
            assert row["terms"] == sorted(row["terms"])
            src, tf = iter(row["src"]), iter(row["tf"])
            for term, docs, n in zip(row["terms"], row["docs"], row["posts"], strict=True):
                got[term] = docs, {row["names"][next(src)]: next(tf) for _ in range(n)}
        docs, sources = whole.langs["en"]
        assert got == {t: (n, {s: c[t] for s, c in sources.items() if t in c}) for t, n in docs.items() if n >= 2}


def test_pairs_in_strips_and_long_texts(spark, monkeypatch):
    """A matrix of pairs that does not fit is added up strip by strip, a long text is cut at a separator only."""
    docs = mixed_docs(spark, 120)
    rows = [r.asDict() for r in docs.collect()]
    want = {r for r in brute_divergence(rows, 1) if r[2] == "pair"}
    found = source_divergence.frequencies(docs, 1)
    met = found.drop("shard", "part", "docs").join(source_divergence.languages(docs, found), "lang").toArrow().to_batches()
    for cells in (1, 10, 1 << 20):
        monkeypatch.setattr(source_divergence, "CELLS", cells)
        sums = {}
        for b in source_divergence._corrections(iter(met)):
            for r in b.to_pylist():
                key = r["lang"], r["source"], r["item"]
                sums[key] = sums.get(key, 0) + (r["value"] if r["part"] == "pair" else 0)
        if cells == 1:
            first = sums
        assert {k: v for k, v in sums.items() if v} == {k: v for k, v in first.items() if v}
    assert want
    monkeypatch.setattr(source_divergence, "PIECE", 10)
    text = "Ab cdéfghijklmnopqrstuvwxyz0123 tail x" * 3
    assert [w.decode() for p in source_divergence.pieces(text) for w in p] == re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.replace("A", "a"))


def test_shares_do_not_overflow():
    for count, total, kinds in ((0, 0, 1), (10**15, 3 * 10**15, 10**9), (7, 7, 1), (8 * 10**15, 8 * 10**15, 3)):
        assert int(source_divergence.share(count, total, kinds)) == 1 + 10**9 * (count + 5) // (total + 5 * kinds)
