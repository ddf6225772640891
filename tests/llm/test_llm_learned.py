"""Toxicity and the pipeline."""

import zlib
from collections import Counter, defaultdict

import pytest
from llm_rows import EMPTY, odd_docs

import __spark_entry__ as entry
import corpus_pipeline
from dotreef.llm import near_dedup, pii, toxicity
from dotreef.llm.common import documents

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.1"


def test_grammar_weighs_what_stands_around():
    m = toxicity.Model(words={"idiot": 2.0})
    weight = lambda text: m.clause(text.split(), {"idiot": 2.0})[0]
    plain = weight("the idiot came")
    assert weight("you idiot") > plain > weight("she is not an idiot") > 0
    assert plain > weight("he wrote idiot") or weight("someone wrote idiot") < plain
    assert weight("not a b c d e idiot") == plain  # a negation reaches three words
    assert weight("kill you idiot") > weight("you idiot")
    assert weight("kill the idiot") == plain  # a threat needs a target


def test_composition_has_every_state():
    states = {s for s, _ in toxicity.GRAMMAR}
    assert all((s, c) in toxicity.GRAMMAR for s in states for c in toxicity.CLASSES)
    assert all(s in states for s, _ in toxicity.GRAMMAR.values())


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int, extra string")


def test_held_out_rows_teach_nothing(spark):
    rows = [(i, f"some plain words {'grumbleface' if i % 2 else 'sunshine'} and more {i}", "x") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    held = {i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0}
    honest = labels_of(spark, [(i, i % 2, None) for i in range(400)])
    lied = labels_of(spark, [(i, i % 2 if i not in held else 1 - i % 2, None) for i in range(400)])
    one, two = toxicity.fit(docs, honest), toxicity.fit(docs, lied)
    assert one == two and (one.words or one.stems)
    got = {r["doc_id"]: r for r in toxicity.classify(docs, honest).collect()}
    assert all(r["predicted"] == i % 2 and r["held_out"] == (i in held) for i, r in got.items())


def test_awkward_rows(spark):
    docs = odd_docs(spark)
    model = toxicity.Model(words={"epsilon": 3.0}, coefficients=(-1.0, 3.0, 0.0, 0.0))
    assert toxicity.score(docs, model).count() == docs.count()
    kept = toxicity.clean_rows(docs, model)
    assert kept.columns == docs.columns and kept.count() == docs.count() - docs.where("text LIKE '%epsilon%'").count()
    none = labels_of(spark, [])
    for labels in (none, labels_of(spark, [(3, 1, None), (4, None, "x"), (None, 1, None)]), labels_of(spark, [(i, 0, None) for i in range(9)])):
        rows = toxicity.classify(docs, labels).collect()
        assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert toxicity.classify(EMPTY(spark), none).count() == 0


def test_accuracy_on_held_out_rows(spark):
    found = toxicity.classify(documents(spark, MEDIUM), spark.read.parquet(f"{MEDIUM}/labels.parquet"))
    rows = found.where("held_out").join(spark.read.parquet(f"{MEDIUM}/labels.parquet"), "doc_id").collect()
    right = sum(r["predicted"] == r["toxic"] for r in rows)
    caught = [r["predicted"] for r in rows if r["toxic"]]
    assert right / len(rows) >= 0.97 and sum(caught) / len(caught) >= 0.9


def test_pipeline_against_a_plain_version(spark):
    model = toxicity.fit(documents(spark, SMALL), spark.read.parquet(f"{SMALL}/labels.parquet"))
    docs = [r.asDict() for r in documents(spark, SMALL).collect()]
    docs = [d for d in docs if model.score(d["text"] or "") < 0.5]
    best = defaultdict(int)
    for d in docs:
        best[d["text"]] = max(best[d["text"]], d["doc_id"])
    docs = sorted((d for d in docs if best[d["text"]] == d["doc_id"]), key=lambda d: d["doc_id"])
    bags = [near_dedup.bag(d["text"]) for d in docs]
    top = list(range(len(docs)))
    for j in range(len(docs)):
        for i in range(j):
            if len(bags[i][0]) and near_dedup.overlap(bags[i], bags[j]) >= 0.8:
                a, b = min(top[i], top[j]), max(top[i], top[j])
                top = [a if t == b else t for t in top]
    docs = [d for k, d in enumerate(docs) if top[k] == k]

    stage_docs = documents(spark, SMALL)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage_docs = corpus_pipeline.stored(stage(spark, stage_docs, SMALL), name)
        assert stage_docs.columns == documents(spark, SMALL).columns
    got = {r["doc_id"]: r for r in stage_docs.collect()}
    assert {i: r["text"] for i, r in got.items()} == {d["doc_id"]: pii.mask(d["text"]) for d in docs}
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())

    rows = corpus_pipeline.run(spark, SMALL).select("doc_id", "length", "doc_tokens").collect()
    total = Counter()
    for r in rows:
        total[r["doc_id"]] += r["length"]
    assert set(total) == set(got) and all(total[r["doc_id"]] == r["doc_tokens"] for r in rows)


def test_stages_on_awkward_rows(spark, tmp_path):
    spark.createDataFrame([(3, 1), (5, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd_docs(spark), EMPTY(spark)):
        out = docs
        for name, stage in corpus_pipeline.STAGES:
            out = corpus_pipeline.stored(stage(spark, out, str(tmp_path)), name)
        assert out.count() == 0 or "sequence_id" in out.columns


_LONGS = lambda *names: dict.fromkeys(names, "bigint")
#: Columns that each query must return.
CONTRACT = {
    "op1_packing": _LONGS("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"),
    "op2_licences": {**_LONGS("doc_id", "n_words", "n_base", "first_word", "last_word"), "base_labels": "string", "labels": "string", "score": "double"},
    "op3_repeats": {**_LONGS("doc_id", "n_bytes", "n_removed", "n_spans"), "kept_sha256": "string"},
    "op4_exact_dedup": {**_LONGS("doc_id", "keep_id", "group_size"), "kept": "boolean", "text_sha256": "string"},
    "op5_sharding": {**_LONGS("doc_id", "size", "text_crc32", "slot"), "law": "string", "shard": "int", "grown_shard": "int"},
    "op6_vector_links": {**_LONGS("vec_id", "n_links", "component_id"), "kept": "boolean"},
    "op7_bpe": {**_LONGS("doc_id", "n_tokens"), "ids_sha256": "string", "decoded_sha256": "string"},
    "op8_near_dedup": {**_LONGS("doc_id", "class_id"), "kept": "boolean"},
    "op9_pii": {**_LONGS("doc_id", "n_email", "n_ip", "n_card", "n_phone"), "base_sha256": "string", "spans": "string"},
    "op10_toxicity": {**_LONGS("doc_id"), "held_out": "boolean", "score": "double", "predicted": "int"},
    "op11_filter_audit": {**_LONGS("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"), "part": "string", "filter_order": "string", "step": "int"},
    "op12_source_divergence": {**dict.fromkeys(("lang", "source", "part", "item"), "string"), "value": "bigint", "rank": "int"},
    "op13_lm_scoring": {**_LONGS("doc_id", "n_tokens", "n_known", "train_tokens"), "held_out": "boolean", "base_score": "double", "score": "double"},
}


@pytest.mark.parametrize("name", [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()])
def test_registered_operators(spark, name):
    from check import compare, connect

    df = entry.queries()[name](spark, SMALL).cache()
    assert {c: dict(df.dtypes)[c] for c in CONTRACT[name]} == CONTRACT[name]
    table, ids = ("embeddings", "vec_id") if "vec_id" in df.columns else ("documents", "doc_id")
    if ids in df.columns:
        whole = spark.read.parquet(f"{SMALL}/{table}.parquet")
        assert {r[0] for r in df.select(ids).distinct().collect()} == {r[0] for r in whole.select(ids).collect()}
        assert df.count() == whole.count() or name == "op1_packing"
    if name in entry.oracle_sql():
        assert compare(spark, connect(SMALL), SMALL, name) == ""


def test_pipeline_is_registered():
    assert "pipeline" in entry.queries()


def test_a_stage_leaves_only_what_the_next_one_reads(spark):
    from dotreef.sources import sinks

    first, shared = sinks.scratch_count(), spark.conf.get("spark.checkpoint.dir")
    from pathlib import Path

    before = set(Path(shared).iterdir())
    packed = corpus_pipeline.run(spark, SMALL)
    left = set(Path(shared).iterdir()) - before
    assert len(left) == 1 and next(iter(left)).name.endswith("-pii") and sinks.scratch_count() == first + 1
    assert packed.count() > 0
    sinks.drop_scratch(spark, first)
    assert set(Path(shared).iterdir()) == before


def test_session_settings_are_as_before(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    assert entry.queries()["op4_exact_dedup"](spark, SMALL).count() == 200
    assert spark.conf.get(key, None) == before


def test_aimed_threat_needs_no_learned_word(spark):
    rows = [(i, f"some plain words {'grumbleface' if i % 8 == 0 else 'sunshine'} and more {i}", "x") for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    model = toxicity.fit(docs, labels_of(spark, [(i, int(i % 8 == 0), None) for i in range(800)]))
    aimed = ["I will kill you", "some plain words. Ich werde dich töten", "te voy a matar", "plain words " * 500 + "; we will hurt you"]
    plain = ["kill the process", "I will not kill you", "it may beat. All of you know", "he wrote I will kill you", "you are welcome", "", "some plain words"]
    for m in (model, toxicity.Model(), toxicity.Model(coefficients=(-30.0, 0.0, 0.0, 0.0))):
        assert all(m.score(t) >= 0.5 for t in aimed)
        assert all(m.score(t) < 0.5 for t in plain)
    more = spark.createDataFrame([(1, aimed[0], "a"), (2, plain[0], "b")], docs.schema)
    assert [r["doc_id"] for r in toxicity.clean_rows(more, model).collect()] == [2]


def test_labelled_threats_move_the_prior(spark):
    texts = lambda i: f"{'grumbleface' if i % 8 == 0 else 'we will beat you' if i % 2 else 'sunshine'} and more {i}"
    docs = spark.createDataFrame([(i, texts(i), "x") for i in range(800)], "doc_id long, text string, source string")
    model = toxicity.fit(docs, labels_of(spark, [(i, int(i % 8 == 0), None) for i in range(800)]))
    assert model.score("we will beat you") < 0.5 < model.score("grumbleface")


def test_rows_of_one_document_weigh_one(spark, monkeypatch):
    rows = [(i, f"some plain words {'grumbleface' if i % 2 else 'sunshine'} and more {i}", "x") for i in range(400)]
    hot = [(2, f"some plain words sunshine and again {k}", "x") for k in range(600)]
    docs = spark.createDataFrame(rows + hot, "doc_id long, text string, source string")
    labels = labels_of(spark, [(i, i % 2, None) for i in range(400)])
    fitted, own = [], toxicity._logistic
    monkeypatch.setattr(toxicity, "_logistic", lambda x, y, *more: fitted.append(len(x)) or own(x, y, *more))
    toxicity.fit(docs, labels)
    assert fitted == [sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(400))]


HARMLESS = [
    "you burn 300 calories an hour", "She will beat the eggs until they burn", "He hurt his knee and they carried him off", "du hang dort", "I will shoot you an email",
    "will you kill the process", "I hope you kill it at the concert", "we will beat you at chess", "I'll burn you a copy", "they want to shoot you from the left side",
    "you can kill time here", "he will destroy them in the final", "I kill time with you", "ich hoffe du willst mich nicht töten", "je pense que vous êtes là pour frapper à la porte",
]
VOWS = ["I will shoot you", "we will kill you all", "ich werde dich töten", "je vais te tuer", "te voy a matar", "I am going to murder you", "we hurt you, not them"]


@pytest.mark.parametrize("base", [-3.0, -4.0, -6.0, -20.0])
def test_everyday_clauses_are_no_threats(base):
    m = toxicity.Model(coefficients=(base, 0.0, 0.0, 0.0))
    assert [t for t in HARMLESS if m.score(t) >= 0.5] == []
    assert [t for t in VOWS if m.score(t) < 0.5] == []


def test_insults_said_of_somebody_weigh_more():
    m = toxicity.Model(words={"idiot": 2.0})
    weight = lambda text: m.clause(text.split(), {"idiot": 2.0})[0]
    assert weight("you are an idiot") > weight("you idiot") > weight("an idiot") > weight("you are not an idiot")
    assert weight("kill you idiot") > weight("you idiot") and weight("kill the idiot") == weight("the idiot")


def test_a_third_of_the_clean_rows_with_such_clauses_stay(spark):
    rows = [(i, f"{HARMLESS[i % len(HARMLESS)]} and more {i}" if i % 3 else f"grumbleface sunshine {i}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scored = toxicity.classify(docs, labels_of(spark, [(i, int(i % 3 == 0), None) for i in range(600)])).collect()
    assert all(r["predicted"] == (r["doc_id"] % 3 == 0) for r in scored)
