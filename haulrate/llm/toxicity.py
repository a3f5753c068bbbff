"""Toxicity by a weighted finite-state grammar over clauses.

A trie of weighted arcs (whole words and word beginnings) turns words into the symbols ``insult``,
``threat``, ``target``, ``negation``, ``report`` and ``quote``. Over the symbols of a clause run
three composed transducers: negation turns what follows it within a few words into its negated
form, reported speech and quotation turn it into its reported form, and the target transducer
marks what stands near a target as directed. What comes out are weighted matches such as a directed
insult or a reported threat; a clause counts with its best match of each kind, and a document's
score is logistic in the sums over its clauses. Words alone score nothing.

Learnt from labelled training rows (a bounded sample, ``TRAINING_ROWS``): the weights of insult
arcs, as smoothed log odds of the words and word beginnings that labels tell apart beyond chance,
and the weight of each kind of match. Both start from written defaults, which small tables keep.

Defined cases: a null text is empty; a text without a match has the score of the bias alone. Labels
are joined by id; a null or absent label teaches nothing, of repeated ones the largest counts.
Repeated rows score alike, texts are read whole, other columns are not read. An empty table gives
an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulrate.llm.common import bounded_sample, filled, fresh, in_fold, map_texts

TRAINING_ROWS = 20_000
LARGEST_LEXICON = 4096
PREFIXES = (3, 4, 5, 6)
LEAST_DOCUMENTS = 4
#: Nats by which a word's labels must differ from the base rate: far beyond a million chances.
LEAST_EVIDENCE = 14.0
#: Of the documents with an arc, the share that has to be toxic.
LEAST_SHARE = 0.97
#: Of the toxic documents, the share that has to hold an arc: more than copies of one text make up.
LEAST_SUPPORT = 0.005
NEAR = 3
THRESHOLD = 0.5

INSULTS = ("idiot", "moron", "scum", "trash", "loser", "stupid", "worthless", "pathetic")
INSULTS += ("disgusting", "filth", "vermin", "imbecile", "arschloch", "idiota", "connard")
THREATS = ("kill", "murder", "strangle", "shoot", "stab", "destroy", "umbringen", "matar", "tuer")
TARGETS = ("you", "your", "yours", "he", "she", "they", "them", "him", "her", "people", "du")
TARGETS += ("dich", "dein", "ihr", "euch", "tu", "toi", "vous", "ton", "usted", "ustedes")
TARGETS += ("vosotros",)
NEGATIONS = ("not", "no", "never", "isn't", "aren't", "don't", "nicht", "kein", "keine", "nie")
NEGATIONS += ("pas", "jamais", "nunca", "jamás")
REPORTS = ("said", "says", "called", "calls", "wrote", "quoted", "claimed", "sagte", "nannte")
REPORTS += ("dit", "appelé", "dijo", "llamó")
QUOTES = ('"', "“", "”", "«", "»", "„")

KINDS = ("insult", "threat")
FORMS = ("plain", "directed", "negated", "reported")
MATCHES = tuple(f"{form} {kind}" for kind in KINDS for form in FORMS)
#: Weights of the matches before anything is learnt, and the bias.
DEFAULTS = np.array([1.0, 1.4, 0.2, 0.5, 1.0, 1.6, 0.2, 0.5])
DEFAULT_BIAS = -3.0
SEED_WEIGHT = 4.0
WEIGHT_SCALE = 4.0
PRIOR = 1.0

_CLAUSE_END = ".!?;\n"
_SYMBOLS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[\"“”«»„]")
_WORD = re.compile(r"[^\W\d_]+")
_ROLES = {word: "target" for word in TARGETS} | {word: "negation" for word in NEGATIONS}
_ROLES |= {word: "report" for word in REPORTS} | {mark: "quote" for mark in QUOTES}


@dataclass
class Transducer:
    """Deterministic: ``step(state, symbol) -> (state, symbol)``; states are small tuples."""

    start: tuple
    step: object

    def then(self, other: Transducer) -> Transducer:
        """The composition: what this one puts out is the other one's input."""
        cut = len(self.start)

        def both(state, symbol):
            mine, symbol = self.step(state[:cut], symbol)
            theirs, symbol = other.step(state[cut:], symbol)
            return mine + theirs, symbol

        return Transducer(self.start + other.start, both)


def _negate(state, symbol):
    """The state counts down the words that a negation still reaches."""
    (left,) = state
    if symbol == "negation":
        return (NEAR,), "word"
    if symbol in KINDS and left:
        return (0,), f"negated {symbol}"
    return (max(0, left - 1),), symbol


def _report(state, symbol):
    """After a verb of saying, or inside quotation marks, matches are reported."""
    reported, quoted = state
    if symbol == "report":
        return (True, quoted), "word"
    if symbol == "quote":
        return (reported, not quoted), "word"
    if symbol in KINDS and (reported or quoted):
        return state, f"reported {symbol}"
    return state, symbol


def _direct(state, symbol):
    """A match within a few words after a target is directed; a target soon after one directs it."""
    since, pending, kind = state
    if symbol == "target":
        out = f"late directed {kind}" if pending else "word"
        return (NEAR, 0, ""), out
    if symbol in KINDS:
        if since:
            return (since - 1, 0, ""), f"directed {symbol}"
        return (0, NEAR, symbol), f"plain {symbol}"
    return (max(0, since - 1), max(0, pending - 1), kind if pending > 1 else ""), symbol


GRAMMAR = (
    Transducer((0,), _negate)
    .then(Transducer((False, False), _report))
    .then(Transducer((0, 0, ""), _direct))
)


def clause_matches(symbols: list[tuple[str, float]]) -> dict[str, float]:
    """The best weight of each kind of match that the grammar finds in a clause."""
    state, best, last = GRAMMAR.start, {}, 0.0
    for symbol, weight in symbols:
        state, out = GRAMMAR.step(state, symbol)
        if out in _PLACE:
            last = weight
            best[out] = max(best.get(out, 0.0), weight)
        elif out.startswith("late "):
            best[out[5:]] = max(best.get(out[5:], 0.0), last)
    return best


_PLACE = {name: k for k, name in enumerate(MATCHES)}


@dataclass
class Model:
    """Weighted arcs by word, weighted arcs by word beginning, weights of matches, bias."""

    words: dict[str, tuple[str, float]] = field(default_factory=dict)
    prefixes: dict[str, tuple[str, float]] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=DEFAULTS.copy)
    bias: float = DEFAULT_BIAS


def seeded() -> Model:
    words = {word: ("insult", SEED_WEIGHT) for word in INSULTS}
    return Model(words | {word: ("threat", SEED_WEIGHT) for word in THREATS})


class Matcher:
    """Finds the clauses of a text that hold an insult or threat, and runs the grammar on them."""

    def __init__(self, model: Model):
        self._model = model
        self._arcs = ahocorasick.Automaton()
        for arc in {**model.words, **model.prefixes}:
            self._arcs.add_word(arc, len(arc))
        self._arcs.make_automaton()

    def _symbol(self, word: str) -> tuple[str, float]:
        found = self._model.words.get(word)
        if found:
            return found
        for size in range(max(PREFIXES), min(PREFIXES) - 1, -1):
            if found := self._model.prefixes.get(word[:size]):
                return found
        return _ROLES.get(word, "word"), 0.0

    def features(self, text: str) -> tuple[list[float], int]:
        """Sums over clauses of the best weight of each match, and the number of such clauses."""
        text = text.lower()
        sums, clauses, end = [0.0] * len(MATCHES), 0, -1
        for last, size in self._arcs.iter(text):
            start = last + 1 - size
            if start < end or start and text[start - 1].isalpha():
                continue
            begin = max(text.rfind(mark, 0, start) for mark in _CLAUSE_END) + 1
            ends = [at for mark in _CLAUSE_END if (at := text.find(mark, start)) >= 0]
            end = min(ends, default=len(text))
            symbols = [self._symbol(word) for word in _SYMBOLS.findall(text, begin, end)]
            matches = clause_matches(symbols)
            clauses += bool(matches)
            for name, weight in matches.items():
                sums[_PLACE[name]] += weight / WEIGHT_SCALE
        return sums, clauses


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _lexicon(rows: DataFrame, toxic: int, total: int) -> list[tuple[str, str, float]]:
    """(arc, ``word`` or ``prefix``, weight) of what the labels tell apart, best first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                seen = {0: Counter(), 1: Counter()}
                for text, label in zip(part["text"].to_pylist(), part["toxic"].to_pylist()):
                    words = set(_WORD.findall(text.lower()))
                    arcs = {(word, "word") for word in words if len(word) <= 32}
                    arcs |= {(w[:n], "prefix") for w in words for n in PREFIXES if len(w) > n}
                    seen[label].update(arcs)
                arcs = list(seen[0] | seen[1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([arc for arc, _ in arcs], pa.string()),
                        pa.array([kind for _, kind in arcs], pa.string()),
                        pa.array([seen[1][arc] for arc in arcs], pa.int64()),
                        pa.array([seen[0][arc] for arc in arcs], pa.int64()),
                    ],
                    names=["arc", "kind", "bad", "good"],
                )

    counts = (
        rows.mapInArrow(count, "arc string, kind string, bad bigint, good bigint")
        .groupBy("arc", "kind")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .where(F.col("bad") >= max(LEAST_DOCUMENTS, LEAST_SUPPORT * toxic))
    )
    base = toxic / total
    bad, good = F.col("bad"), F.col("good")
    share = bad / (bad + good)
    evidence = bad * F.log(share / base) + F.when(
        good > 0, good * F.log((1 - share) / (1 - base))
    ).otherwise(0.0)
    odds = F.log((bad + 0.5) / (toxic + 1)) - F.log((good + 0.5) / (total - toxic + 1))
    best = (
        counts.withColumns({"evidence": evidence, "weight": odds})
        .where((share >= LEAST_SHARE) & (F.col("evidence") >= LEAST_EVIDENCE))
        .orderBy(F.desc("evidence"), "arc", "kind")
        .limit(LARGEST_LEXICON)
    )
    return [(row["arc"], row["kind"], row["weight"]) for row in best.collect()]


def _fit_weights(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps, held towards the written defaults."""
    design = np.hstack([x, np.ones((len(x), 1))])
    prior = np.append(DEFAULTS, DEFAULT_BIAS)
    hold = np.append(np.full(len(DEFAULTS), PRIOR), 0.01)
    theta = prior.copy()
    for _ in range(50):
        p = _logistic(design @ theta)
        gradient = design.T @ (p - y) + hold * (theta - prior)
        curvature = (design * (p * (1 - p))[:, None]).T @ design + np.diag(hold)
        step = np.linalg.solve(curvature, gradient)
        theta -= step * min(1.0, 2.0 / max(1e-9, float(np.abs(step).max())))
        if float(np.abs(step).max()) < 1e-8:
            break
    return theta[:-1], float(theta[-1])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from labelled rows outside the held-out fold, at most about ``TRAINING_ROWS``."""
    model = seeded()
    known = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    sample = F.broadcast(bounded_sample(known, TRAINING_ROWS, "doc_id"))
    rows = filled(docs).join(sample, "doc_id").select("text", "toxic").distinct()
    counted = rows.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    total, toxic = counted["n"], counted["toxic"] or 0
    if not 0 < toxic < total:
        return model
    for arc, kind, weight in _lexicon(rows, toxic, total):
        arcs = model.words if kind == "word" else model.prefixes
        arcs[arc] = ("insult", weight)
    found = _features(rows, model, ("toxic",)).select("toxic", "features").collect()
    x = np.array([row["features"] for row in found])
    model.weights, model.bias = _fit_weights(x, np.array([row["toxic"] for row in found]))
    return model


def held_out() -> Column:
    return in_fold(F.col("doc_id"), 0)


def _features(docs: DataFrame, model: Model, keep: tuple[str, ...]) -> DataFrame:
    def make():
        matcher = Matcher(model)

        def step(texts):
            found = [matcher.features(text) for text in texts]
            return {"features": [x for x, _ in found], "clauses": [n for _, n in found]}

        return step

    return map_texts(docs, make, "features array<double>, clauses bigint", keep)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs``: its fold, its score, the prediction, and its matched clauses."""
    terms = [F.col("features")[k] * float(w) for k, w in enumerate(model.weights)]
    logit = sum(terms, F.lit(model.bias))
    return (
        _features(filled(docs), model, ("doc_id",))
        .withColumn("score", 1 / (1 + F.exp(-logit)))
        .select(
            "doc_id",
            held_out().alias("held_out"),
            "score",
            (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
            F.col("clauses").alias("n_clauses"),
        )
    )


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, all columns as they are."""
    model, names = fit(docs, labels), tuple(docs.columns)
    least, flag = math.log(THRESHOLD / (1 - THRESHOLD)), fresh(docs, "_toxic")

    def make():
        matcher = Matcher(model)

        def step(texts):
            found = [matcher.features(text or "")[0] for text in texts]
            return {flag: [float(np.dot(x, model.weights)) + model.bias >= least for x in found]}

        return step

    return map_texts(docs, make, f"{flag} boolean", names).where(~F.col(flag)).drop(flag)
