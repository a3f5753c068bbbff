"""Quality from weak labels: heuristic labellers, their accuracies by EM, a hashed linear scorer.

Each labeller votes good, bad or abstains on a document. Over all documents the votes are counted
by pattern, of which there is a fixed number, and expectation-maximisation on these counts gives
for both classes how often each labeller votes what, so labellers that overlap and contradict one
another weigh as much as they are worth. The posterior of a pattern is the label of its documents.
On a bounded sample (``TRAINING_ROWS``) those soft labels train a logistic regression on hashed
words and signs, which scores every document. No true label is read.

Defined cases: a null text is empty, and empty texts are voted on and scored like others. Repeated
rows score alike, texts are read whole, other columns are not read. If all posteriors agree on a
class, the score is that of the class prior. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulrate.llm.common import bounded_sample, filled

TRAINING_ROWS = 20_000
#: Posterior of good where no labeller votes bad: it ties the classes to their names.
UNFLAGGED = 0.999
#: No labeller calls more good documents bad than this share; kinds of junk seldom coincide, so
#: without a bound the commonest kind alone would become the bad class.
FALSE_ALARMS = 0.002
START_SHARE = 0.85
FEATURES = 1 << 14
ITERATIONS = 40
PENALTY = 1e-4
STEPS = 200
SMOOTHING = 1.0
#: P(abstains, good, bad) before the first step, for good and for bad documents.
START_GOOD, START_BAD = (0.099, 0.9, 0.001), (0.1, 0.7, 0.2)

def _signals() -> dict[str, Column]:
    text = F.col("text")
    length = F.greatest(F.length(text), F.lit(1))
    lines, words = F.split(text, "\n"), F.split(text, r"\s+")
    return {
        "words": F.size(words),
        "symbols": F.regexp_count(text, F.lit(r"[^\p{L}\p{N}\s.,|]")) / length,
        "upper": F.regexp_count(text, F.lit(r"\p{Lu}")) / length,
        "digits": F.regexp_count(text, F.lit(r"\p{N}")) / length,
        "bars": (F.length(text) - F.length(F.replace(text, F.lit("|")))) / F.size(words),
        "lines": F.size(F.array_distinct(lines)) / F.size(lines),
        "unique": F.size(F.array_distinct(words)) / F.size(words),
    }


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, 2).when(good, 1).otherwise(0)


#: Votes: 0 abstains, 1 good, 2 bad.
LABELLERS = {
    "length": lambda s: _vote(s["words"] >= 40, F.lit(False)),
    "symbols": lambda s: _vote(s["symbols"] < 0.02, s["symbols"] > 0.06),
    "upper": lambda s: _vote(s["upper"] < 0.1, s["upper"] > 0.3),
    "digits": lambda s: _vote(s["digits"] < 0.05, s["digits"] > 0.2),
    "bars": lambda s: _vote(s["bars"] < 0.02, s["bars"] > 0.1),
    "lines": lambda s: _vote(s["lines"] > 0.9, s["lines"] < 0.5),
    "unique": lambda s: _vote((s["unique"] > 0.4) | (s["words"] < 20), s["unique"] < 0.2),
}
VOTES = 3


def with_votes(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and the pattern of votes as one number in base three."""
    signals = _signals()
    measured = docs.withColumns({f"_{name}": signal for name, signal in signals.items()})
    columns = {name: F.col(f"_{name}") for name in signals}
    pattern = F.lit(0)
    for k, vote in enumerate(LABELLERS.values()):
        pattern = pattern + vote(columns) * VOTES**k
    return measured.withColumn("votes", pattern.cast("int")).select("doc_id", "text", "votes")


def digits_of(patterns: np.ndarray) -> np.ndarray:
    """The vote of every labeller, a row for each pattern."""
    return patterns[:, None] // VOTES ** np.arange(len(LABELLERS)) % VOTES


def estimate(patterns: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of good for each pattern, P(vote | class) for each labeller, P(good).

    Starts from labellers that seldom call a good document bad, which tells the classes apart.
    """
    votes = digits_of(patterns)
    labellers, flagged = np.arange(votes.shape[1]), (votes == 2).any(axis=1)
    emit = np.empty((2, votes.shape[1], VOTES))
    emit[1], emit[0] = START_GOOD, START_BAD
    good = START_SHARE
    posterior = np.full(len(patterns), 0.5)
    for _ in range(STEPS):
        logs = [np.log(emit[c][labellers, votes]).sum(axis=1) for c in (0, 1)]
        odds = np.clip(logs[1] - logs[0] + np.log(good / (1 - good)), -50, 50)
        new = np.where(flagged, 1 / (1 + np.exp(-odds)), UNFLAGGED)
        done = np.abs(new - posterior).max(initial=0.0) < 1e-9
        posterior = new
        weights = (counts * (1 - posterior), counts * posterior)
        total = counts.sum() + 2 * SMOOTHING
        good = float((weights[1].sum() + SMOOTHING) / total)
        for c in (0, 1):
            for v in range(VOTES):
                emit[c, :, v] = (weights[c][:, None] * (votes == v)).sum(axis=0) + SMOOTHING
            emit[c] /= emit[c].sum(axis=1, keepdims=True)
        emit[1, :, 2] = np.minimum(emit[1, :, 2], FALSE_ALARMS)
        emit[1, :, :2] *= (1 - emit[1, :, 2:]) / emit[1, :, :2].sum(axis=1, keepdims=True)
        if done:
            break
    return posterior, emit, good


def _terms() -> Column:
    """Lower-case words, runs of other signs, and how often words repeat."""
    words = F.split(F.lower("text"), r"\s+")
    distinct = F.array_distinct(words)
    signs = F.regexp_extract_all("text", F.lit(r"([^\p{L}\p{N}\s]{1,4})"), F.lit(1))
    unique = F.floor(10 * F.size(distinct) / F.size(words)).cast("string")
    return F.concat(
        distinct,
        F.transform(F.array_distinct(signs), lambda sign: F.concat(F.lit("#"), sign)),
        F.array(F.concat(F.lit("#unique "), unique)),
    )


def weak_labels(docs: DataFrame) -> tuple[DataFrame, float]:
    """The rows of ``with_votes`` with the posterior of good, and the share of good."""
    voted = with_votes(docs)
    found = voted.groupBy("votes").count().collect()
    patterns = np.array([row["votes"] for row in found], dtype=np.int64)
    posterior, _, good = estimate(patterns, np.array([row["count"] for row in found], dtype=float))
    weak = F.lit(good)
    if found:
        pairs = zip(patterns.tolist(), posterior.tolist())
        weak = F.create_map(*[F.lit(x) for pair in pairs for x in pair])[F.col("votes")]
    return voted.withColumn("weak_label", weak), good


def judge(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: the score (0 to 1, higher is better), the class, whether to keep it."""
    docs = filled(docs)
    labelled, good = weak_labels(docs)
    return _scored(docs, bounded_sample(labelled, TRAINING_ROWS, "doc_id"), good).select(
        "doc_id",
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        (F.col("score") >= 0.5).alias("kept"),
    )


def _scored(docs: DataFrame, sample: DataFrame, good: float) -> DataFrame:
    hashing = HashingTF(
        numFeatures=FEATURES, binary=True, inputCol="_terms", outputCol="_features"
    )
    share = sample.agg(F.avg("weak_label")).first()[0]
    if share is None or not 1e-6 < share < 1 - 1e-6:
        return docs.withColumn("score", F.lit(good))
    soft = [
        F.struct(F.lit(1.0).alias("label"), F.col("weak_label").alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (1 - F.col("weak_label")).alias("weight")),
    ]
    training = (
        hashing.transform(sample.select(_terms().alias("_terms"), "weak_label"))
        .select("_features", F.explode(F.array(*soft)).alias("soft"))
        .select("_features", "soft.label", "soft.weight")
        .where("weight > 1e-6")
    )
    model = LogisticRegression(
        featuresCol="_features", weightCol="weight", regParam=PENALTY, maxIter=ITERATIONS
    ).fit(training)
    scored = model.transform(hashing.transform(docs.withColumn("_terms", _terms())))
    return scored.withColumn("score", vector_to_array("probability")[1])
