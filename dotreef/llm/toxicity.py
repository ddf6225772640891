"""Toxicity by a weighted finite-state grammar over clauses.

A lexical transducer turns words into classes (insult, threat, target, speaker, negation, reported speech and a few more) with weights; insults and
their stems are learned from labelled rows. Small transducers for insult, target, threat, negation and reported speech are composed into one grammar that
multiplies the weight of an insult or threat by what stands around it in its clause. A document's features are sums over its matched clauses, and its
heaviest vow, which needs no learned word: the speaker, then a verb of violence with the person addressed as its object ("I will shoot you", "ich werde dich
töten", but neither "you burn calories" nor "I will shoot you an email"). A logistic function fitted on the same rows makes a score of the features. The
weight of vows has a prior that holds where no labelled row has one; verbs with everyday meanings (``MILD``) stay below one half until labels support them.

NULL and empty text match nothing and score the base rate. Repeated rows score alike; only ``text`` enters a score. Without labelled rows of
both kinds the lexicon is empty and every score without a vow is the share of toxic rows, or 0 without any.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import per_document, stored, texts, tune

#: Labelled rows that the lexicon and the logistic function are fitted on, at most: an even sample by hash of doc_id.
SAMPLE = 40_000
#: Entries of the learned lexicon, at most, and what an entry must show: log odds less one standard error, which are also its weight, and
#: so many distinct toxic texts that among all entries seen only ``CHANCE`` would have them by chance.
ENTRIES, LEAST_ODDS, CHANCE = 5_000, 2.5, 0.05
STEMS = (4, 5, 6, 7, 8)

# Words of the closed classes.
TARGETS = frozenset("you your yours u ur he she they him her them these those du dich dir ihr euch sie tu te toi vous il elle ils tú te vos usted él ella ellos".split())
NEGATIONS = frozenset("not no never neither nor isn aren wasn weren don doesn didn nicht kein keine nie niemals ne pas jamais non nunca jamás tampoco".split())
REPORTS = frozenset("said says say wrote writes quoted quote quotes called claimed according sagte schrieb zitiert dit écrit cité dijo escribió citó".split())
THREATS = frozenset("kill killing murder hurt beat destroy burn shoot stab hang töten umbringen tuer frapper matar golpear".split())
#: Of these, verbs with everyday meanings.
MILD = frozenset("beat destroy burn hang frapper golpear".split())
SPEAKERS = frozenset("i we ich wir je nous yo nosotros voy vamos werde".split())
#: The person addressed: after the verb, and as an object that stands before it.
ADDRESSED, CLITICS = frozenset("you u ya".split()), frozenset("dich dir euch te toi vous os".split())
ARTICLES = frozenset("a an the some one ein eine einen un une una la le el".split())
COPULAS = frozenset("are re is am bist ist sind seid es eres sois est êtes suis".split())

_CLAUSE = re.compile(r"[.!?;:\n|]+")
_WORD = re.compile(r"[^\W_]+")

# Each transducer: (state, class) -> (next state, factor). A class without an arc keeps the state at factor 1.
Arcs = dict[tuple[str, str], tuple[str, float]]
CLASSES = ("insult", "threat", "target", "addressed", "clitic", "speaker", "negation", "report", "article", "copula", "other")
#: Classes that name somebody.
SOMEBODY = ("target", "addressed", "clitic")
#: An insult that is said of somebody ("you are a ...").
INSULT: Arcs = {
    **{("none", c): ("subject", 1.0) for c in SOMEBODY}, ("subject", "copula"): ("said", 1.0), ("said", "insult"): ("said", 1.2),
}
TARGET: Arcs = {
    **{("none", c): ("aimed", 1.0) for c in SOMEBODY}, ("aimed", "insult"): ("aimed", 1.5),
    ("none", "insult"): ("pending", 1.0), **{("pending", c): ("aimed", 1.0) for c in SOMEBODY},
}
#: Accepts in "due" and "vowed" (the speaker, a verb, the person addressed, in the order of the language) and, for clauses that hold an insult as
#: well, in "made" (a verb next to anybody). An article after "due" shows that something else is the object.
THREAT: Arcs = {
    **{("none", c): ("met", 1.0) for c in ("target", "addressed")}, ("none", "clitic"): ("before", 1.0), ("none", "threat"): ("act", 1.0),
    **{(s, "speaker"): ("spoke", 1.0) for s in ("none", "met", "act")}, ("before", "speaker"): ("both", 1.0),
    **{("act", c): ("made", 1.0) for c in SOMEBODY}, **{(s, "threat"): ("made", 1.0) for s in ("met", "before")},
    ("spoke", "clitic"): ("both", 1.0), ("spoke", "threat"): ("open", 1.0), ("both", "threat"): ("vowed", 1.0),
    **{("open", c): ("spoke", 1.0) for c in CLASSES}, ("open", "threat"): ("open", 1.0), ("open", "target"): ("made", 1.0),
    ("open", "addressed"): ("due", 1.0), ("open", "clitic"): ("due", 1.0),
    **{("due", c): ("vowed", 1.0) for c in CLASSES}, ("due", "article"): ("spoke", 1.0),
}
NEGATION: Arcs = {
    **{(s, "negation"): ("no3", 1.0) for s in ("none", "no3", "no2", "no1")},
    **{(s, c): (s, 0.5) for s in ("no3", "no2", "no1") for c in ("insult", "threat")},
    **{(s, c): (t, 1.0) for s, t in (("no3", "no2"), ("no2", "no1"), ("no1", "none")) for c in ("other", "article", "copula")},
}
REPORT: Arcs = {
    ("none", "report"): ("told", 1.0), ("told", "insult"): ("told", 0.6), ("told", "threat"): ("told", 0.6),
}


def compose(*machines: Arcs) -> dict[tuple[tuple[str, ...], str], tuple[tuple[str, ...], float]]:
    """The machines in step: states side by side, factors multiplied."""
    states = [sorted({"none"} | {s for s, _ in m} | {s for s, _ in m.values()}) for m in machines]
    out = {}
    for state in product(*states):
        for c in CLASSES:
            moves = [m.get((s, c), (s, 1.0)) for m, s in zip(machines, state, strict=True)]
            out[state, c] = tuple(s for s, _ in moves), math.prod(f for _, f in moves)
    return out


GRAMMAR = compose(INSULT, TARGET, THREAT, NEGATION, REPORT)
START = ("none",) * 5
MADE = ("due", "vowed", "made")
#: Weight of an unlearned verb of violence, and of one that has everyday meanings, is negated or reported.
THREAT_WEIGHT, MILD_WEIGHT = 1.0, 0.4
#: Prior: log odds of a text whose only match is one vow, neither negated nor reported, and the precision with which labelled
#: rows that have vows meet it.
THREAT_ODDS, THREAT_PRECISION = 2.0, 0.25


def threat_prior(base: float) -> float:
    """Coefficient of the threat feature that gives a lone vow its prior log odds over the intercept ``base``."""
    return max(0.0, THREAT_ODDS - base) / math.log1p(THREAT_WEIGHT)


#: Words of the closed classes; where a word is in several, the first class has it.
LEXICON = {
    w: kind
    for kind, words in reversed([
        ("threat", THREATS), ("addressed", ADDRESSED), ("clitic", CLITICS), ("speaker", SPEAKERS), ("target", TARGETS), ("negation", NEGATIONS),
        ("report", REPORTS), ("copula", COPULAS), ("article", ARTICLES),
    ])
    for w in words
}


@dataclass
class Model:
    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    coefficients: tuple[float, ...] = (-20.0, 0.0, 0.0, 0.0)
    #: Coefficient of the heaviest vow; the prior one if not given.
    threat: float | None = None

    def __post_init__(self) -> None:
        if self.threat is None:
            self.threat = threat_prior(self.coefficients[0])

    def weight(self, word: str) -> float:
        best = self.words.get(word, 0.0)
        for n in STEMS:
            if len(word) >= n and (w := self.stems.get(word[:n], 0.0)) > best:
                best = w
        return best

    def clause(self, words: Sequence[str], known: dict[str, float]) -> tuple[float, int, float]:
        """Weight and number of matches of one clause, and its heaviest vow, 0 without one.

        Threats beside a learned word add to the weight; alone they are no match.
        """
        state, total, hits, threats, last, worst = START, 0.0, 0, 0.0, 0.0, 0.0
        for w in words:
            own = known.get(w, 0.0)
            kind = "insult" if own else LEXICON.get(w, "other")
            before = state[2]
            state, factor = GRAMMAR[state, kind]
            if own:
                total, hits = total + own * factor, hits + 1
            elif kind == "threat":
                last = (MILD_WEIGHT if w in MILD or factor < 1 else THREAT_WEIGHT) * factor
                threats += last
            if state[2] == "vowed" and before != "vowed":
                worst = last
        if state[2] == "due":
            worst = last
        return total + (threats if hits and state[2] in MADE else 0.0), hits, worst

    def features(self, text: str) -> tuple[float, float, float, float]:
        """Logs of the summed clause weights, of the heaviest clause, of the number of different matched words, and of the heaviest vow.

        None depends on the length of the text: a few insults weigh the same in a long one.
        """
        low = text.lower()
        words = set(_WORD.findall(low))
        known = {w: x for w in words if (x := self.weight(w))}
        if not known and words.isdisjoint(THREATS):
            return 0.0, 0.0, 0.0, 0.0
        total = top = worst = 0.0
        for clause in _CLAUSE.split(low):
            weight, _, threat = self.clause(_WORD.findall(clause), known)
            total, top, worst = total + weight, max(top, weight), max(worst, threat)
        return math.log1p(total), math.log1p(top), math.log1p(len(known)), math.log1p(worst)

    def score(self, text: str) -> float:
        z = self.coefficients[0] + sum(c * x for c, x in zip((*self.coefficients[1:], self.threat), self.features(text), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def _entries(words: set[str]) -> set[str]:
    """Features of a document: its words, and stems (with a trailing mark) of those that are longer."""
    out = set(words)
    for w in words:
        if len(w) > 3:
            out.update(w[:n] + "*" for n in STEMS if len(w) >= n)
    return out


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float | Sequence[float] = 1e-2, prior: Sequence[float] | None = None) -> tuple[float, ...]:
    """Intercept and coefficients; ``ridge`` pulls each coefficient towards its ``prior`` (0 if not given)."""
    x = np.column_stack([np.ones(len(x)), x])
    centre = np.array([0.0, *(prior or [0.0] * (x.shape[1] - 1))])
    b = centre.copy()
    penalty = np.diag([1e-6, *np.broadcast_to(ridge, len(b) - 1)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (y - p) - penalty @ (b - centre))
        b += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(b.tolist())


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns from labelled rows that are not held out, at most ``sample`` of them (more labels are thinned by hash of doc_id)."""
    tune(docs.sparkSession)
    marked = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marked = marked.agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where(~held_out(F.col("doc_id")))
    there = marked.count()
    if there > sample:
        marked = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * sample / there))
    rows = stored(texts(docs).join(marked, "doc_id"), "labelled")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for pdf in batches:
            for text, toxic in zip(pdf["text"], pdf["toxic"], strict=True):
                seen[toxic].update(_entries(set(_WORD.findall(text.lower()))))
                seen[toxic][""] += 1
            if sum(map(len, seen)) > 300_000:
                yield _table(seen)
                seen = (Counter(), Counter())
        yield _table(seen)

    # Copies are one piece of evidence.
    counted = rows.groupBy("text").agg(F.max("toxic").alias("toxic")).mapInPandas(count, "entry string, clean long, toxic long")
    counted = stored(counted.groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "entries")
    whole = counted.where("entry = ''").first()
    model = Model()
    if whole is None:
        return model
    clean, toxic = whole["clean"], whole["toxic"]
    if not clean or not toxic:
        return Model(coefficients=(30.0 if toxic else -30.0, 0.0, 0.0, 0.0))
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    least = max(5, math.ceil(math.log(counted.count() / CHANCE) / math.log((clean + toxic) / toxic)))
    odds = odds - F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    best = counted.where((F.col("entry") != "") & (F.col("toxic") >= least)).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
    rows_best = best.orderBy(F.desc(F.col("toxic") * F.col("odds")), "entry").limit(ENTRIES).collect()
    for r in sorted(rows_best, key=lambda r: (len(r["entry"]), r["entry"])):
        entry, w = r["entry"], float(r["odds"])
        if entry.endswith("*"):
            stem = entry[:-1]
            if not any(stem[:n] in model.stems for n in STEMS if n < len(stem)):
                model.stems[stem] = w
        else:
            model.words[entry] = w

    own = model

    def features(batch: list[str]) -> dict[str, Sequence]:
        made = [own.features(t) for t in batch]
        return {n: [m[i] for m in made] for i, n in enumerate(("total", "top", "kinds", "threat"))}

    schema = "total double, top double, kinds double, threat double"
    # Rows of one doc_id count as one document with their mean features: at most one row for each sampled label.
    made = per_document(rows, features, schema, keys=("doc_id", "toxic")).groupBy("doc_id", "toxic")
    table = made.agg(*[F.avg(c).alias(c) for c in ("total", "top", "kinds", "threat")]).orderBy("doc_id").toPandas()
    x, y = table[["total", "top", "kinds", "threat"]].to_numpy(), table["toxic"].to_numpy(float)
    learned = _logistic(x[:, :3], y)
    prior = threat_prior(learned[0])
    if x[:, 3].any():
        *learned, prior = _logistic(x, y, (1e-2, 1e-2, 1e-2, THREAT_PRECISION), (0.0, 0.0, 0.0, prior))
    return Model(model.words, model.stems, tuple(learned), prior)


def _table(seen: tuple[Counter, Counter]) -> pd.DataFrame:
    entries = list({*seen[0], *seen[1]})
    return pd.DataFrame({"entry": entries, "clean": [seen[0][e] for e in entries], "toxic": [seen[1][e] for e in entries]}).astype(
        {"entry": "object", "clean": "int64", "toxic": "int64"}
    )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row."""
    tune(docs.sparkSession)
    return per_document(texts(docs), lambda batch: {"score": [model.score(t) for t in batch]}, "score double")


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, learned from the labels that are not held out."""
    scored = score(docs, fit(docs, labels, sample))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean_rows(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, that score under 0.5."""
    tune(docs.sparkSession)
    names = docs.columns

    def run(batches):
        import pyarrow as pa

        for b in batches:
            found = b.column(names.index("text")).to_pylist()
            yield b.filter(pa.array([model.score(t or "") < 0.5 for t in found], pa.bool_()))

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(run, docs.schema)
