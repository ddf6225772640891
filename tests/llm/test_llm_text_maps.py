"""Operators that map one document at a time: BPE, licence scan, personal data."""

import base64
import hashlib
import random
import re

import public_tokenizers as P
import pytest
import tiktoken
from llm_rows import EMPTY, odd_docs

from dotreef.llm import bpe, licences, pii

RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def plain_codec():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def strange_texts():
    rng = random.Random(5)
    pool = "abc ABC éñß 漢字 \n\t  ..!! 0123 's 't <|endoftext|> 😀 ☃ ​ ́"
    return ["", " ", "a" * 3000, " " * 500, "<|endoftext|>", "\x00\x01", *["".join(rng.choices(pool, k=rng.randint(1, 200))) for _ in range(300)]]


def test_codec_agrees_with_ranks(plain_codec):
    own = bpe.codec(RANKS, P.PATTERN)
    for t in strange_texts():
        ids = own.encode(t)
        assert ids == plain_codec.encode_ordinary(t), repr(t[:40])
        assert own.decode(ids) == t.encode()


def test_codec_forgets_when_full(monkeypatch):
    own = bpe.Codec(RANKS, P.PATTERN)
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    first = [own.encode(t) for t in ("one two three four five six", "seven eight nine ten eleven twelve", "one two")]
    assert first[2] == first[0][:2]


def test_bpe_frames(spark, plain_codec):
    docs = odd_docs(spark)
    got = bpe.encode(docs, RANKS, P.PATTERN)
    want = sorted((r["doc_id"] is None, r["doc_id"], plain_codec.encode_ordinary(r["text"] or "")) for r in docs.collect())
    assert sorted((r["doc_id"] is None, r["doc_id"], list(r["ids"])) for r in got.collect()) == want
    back = bpe.decode(got, RANKS, P.PATTERN)
    assert sorted(r["text"] for r in back.collect()) == sorted(r["text"] or "" for r in docs.collect())
    digests = bpe.encode(docs.where("doc_id = 3"), RANKS, P.PATTERN, bpe.digests, "n_tokens long, ids_sha256 string, decoded_sha256 string").first()
    text = docs.where("doc_id = 3").first()["text"]
    assert digests["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode(EMPTY(spark), RANKS, P.PATTERN).count() == 0


WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def by_hand(text):
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    places = []
    for phrase, label in licences.PHRASES:
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), sorted(places)


LICENSED = [
    "Released UNDER the MIT License. under the mit license", "under under the mit license version 2", "Apache License, Version 2.0",
    "the apache license version apache license version 2", "CC BY-NC 4.0 cc by cc by nc nc", "under the mit license" * 2, "", "É under-the;mit license",
]


def test_phrases_by_hand():
    own = licences.scanner()
    rng = random.Random(3)
    vocabulary = "under the mit license apache version 2 cc by nc of x".split()
    made = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 60))) for _ in range(400)]
    for text in LICENSED + made:
        n, found, _ = own.scan(text)
        assert (n, found) == by_hand(text), text


def test_template_spans():
    own = licences.scanner()
    n, found, spans = own.scan("x y z This work is licensed under the GNU General Public License, version 3. more words")
    assert not found and [(s.label, s.start, s.end) for s in spans if s.coverage == 1] == [("gpl-3", 3, 15)]
    broken = licences.TEMPLATES[0][1].replace("associated documentation", "ASSOCIATED, new documentation")
    assert "mit" in {s.label for s in own.scan("before " + broken + " after")[2]}
    assert own.scan("the software of the license and a copy of the file")[2] == []


def test_licence_frame(spark):
    docs = odd_docs(spark)
    rows = licences.scan(docs).collect()
    assert sorted(r["n_words"] for r in rows) == sorted(by_hand(r["text"] or "")[0] for r in docs.collect())
    assert all(0 <= r["score"] <= 1 and (r["n_base"] > 0) == (r["first_word"] is not None) for r in rows)
    assert licences.scan(EMPTY(spark)).count() == 0


FIXED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_by_hand(text):
    out = []
    for kind, pattern in FIXED.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                    "card": 14 <= len(digits) <= 19 and luhn, "phone": 10 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], list(FIXED).index(s[2])))


def test_plain_spans_by_hand():
    rng = random.Random(11)
    parts = ["a", "b.c", "@", "@x", ".com", " ", "-", "+", "(", ")", "1", "22", "255", "256", "0001", "4111 1111 1111 1111", "4111111111111111", "é", "@@", "."]
    for _ in range(6000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 14)))
        base, every = pii.find(text)
        assert base == plain_by_hand(text), repr(text)
        assert set(base) <= set(every)


def test_long_runs_stay_linear():
    for text in ("a" * 200_000 + " ", "1" * 200_000, "+1" + " " * 200_000, "a@" * 50_000, "1." * 60_000, "(at) " * 20_000, "one two " * 20_000):
        pii.find(text)


@pytest.mark.parametrize(("text", "kind", "part"), [
    ("write to jane [at] example [dot] com now", "email", "jane [at] example [dot] com"),
    ("write to jane.doe(at)mail.example.com!", "email", "jane.doe(at)mail.example.com"),
    ("mail bob at example dot org please", "email", "bob at example dot org"),
    ("mail jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
    ("ring five five five one two three four five six seven ok", "phone", "five five five one two three four five six seven"),
    ("４１１１ 1111 1111 1111 x", "card", "４１１１ 1111 1111 1111"),
    ("ip 10[.]0[.]0[.]1 here", "ip", "10[.]0[.]0[.]1"),
    ("a​nn@example.com", "email", "a​nn@example.com"),
])
def test_disguises(text, kind, part):
    base, every = pii.find(text)
    at = text.index(part)
    assert (at, at + len(part), kind) in every
    assert part not in pii.mask(text)


@pytest.mark.parametrize("text", ["meet me at the station. It is late", "one or two at most", "look at that dot on the wall", "at 3 (at least)", ""])
def test_ordinary_text_has_no_spans(text):
    assert pii.find(text) == ([], [])
    assert pii.mask(text) == text


def test_personal_data_frames(spark):
    docs = odd_docs(spark)
    rows = {r["doc_id"]: r for r in pii.detect(docs).collect()}
    assert rows[4]["n_email"] == 1 and rows[4]["n_ip"] == 1
    empty = hashlib.sha256(b"").hexdigest()
    assert rows[1]["base_sha256"] == empty and rows[1]["spans"] == ""
    out = pii.redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert {r["text"] for r in out.where("doc_id = 4").collect()} == {"mail <email> from <ip>"}
    assert out.where("text IS NULL").count() == docs.where("text IS NULL").count()
    assert pii.redact(EMPTY(spark)).count() == pii.detect(EMPTY(spark)).count() == 0


@pytest.mark.parametrize("host", [f"firma dot {e}" for e in "dk fi cz kr mx ie tv co online com".split()] + ["firma dot it.", "firma dot at", "firma dot me, please"])
def test_bare_at_before_any_ending(host):
    text = f"write to anna at {host}"
    part = text[len("write to ") :].removesuffix(", please").removesuffix(".")
    assert (9, 9 + len(part), "email") in pii.find(text)[1]


def test_names_and_hosts_of_many_parts():
    for text in ("a.b.c.d.e.f [at] host [dot] com", "x" * 90 + " [at] host [dot] com", "a dot b dot c dot d dot e dot f dot g (at) h.i.j.k.l.m.n.o dot org"):
        assert pii.find("to " + text + " now")[1] == [(3, 3 + len(text), "email")]
    for text in ("look at that dot in the corner", "look at the dot me and you", "we met at noon dot it was late", "at red dot design museum"):
        assert pii.find(text)[1] == []
    for text in ("a dot " * 50_000, "x at a dot " + "at dot " * 50_000, " " * 200_000 + "(at) dot x", "a." * 100_000 + " [at] x [dot] com", "a at b dot c" * 2_000,
                 "a [at] " + "b dot " * 50_000 + "1", "[at]" + "a@" * 50_000):
        pii.find(text)


@pytest.mark.parametrize(("text", "labels"), [
    ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
     "the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", {"gpl-2"}),
    ("this work is licensed under the gnu general public license version 2", {"gpl-2"}),
    ("this work is licensed under the gnu general public license version 4", set()),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License", {"cc-by-sa"}),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", {"cc-by-nc"}),
    ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
     "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.", {"mit"}),
])
def test_sibling_licences_are_told_apart(text, labels):
    assert {s.label for s in licences.scanner().scan("x y " + text + " z")[2]} == labels
