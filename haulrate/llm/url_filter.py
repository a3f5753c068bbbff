"""URL filter: rules by host and path, and for the rest a logistic regression on n-grams.

Everything is DataFrame functions and Spark's own ``ml`` estimators: character n-grams of host and
path are hashed, and the regression is trained on the small table of distinct URLs that a rule
judges (up to ``TRAINING_URLS`` of them). Its weights have a fixed size, whatever the input.

Defined cases: a null URL, or one without ``://``, has empty host and path and is judged by the
method; so is a path that does not start with ``/``, which no rule fits. If the rules judge
nothing, or all alike, the method gives ``allow``, or that verdict. Repeated rows are judged alike;
other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulrate.llm.common import bounded_sample, lower_ascii

# Verdict, host, path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
GRAMS = (3, 4)
FEATURES = 1 << 13
TRAINING_URLS = 20_000
ITERATIONS = 40
PENALTY = 1e-3

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def with_parts(pages: DataFrame) -> DataFrame:
    """Adds ``host``, with A-Z in lower case, and ``path``."""
    url = F.coalesce("url", F.lit(""))
    return pages.withColumns(
        {
            "host": lower_ascii(F.regexp_extract(url, _URL, 1)),
            "path": F.regexp_extract(url, _URL, 2),
        }
    )


def rule_of(rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    host, path = F.col("host"), F.col("path")
    for judged, of, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(start)
        rule = F.when(fits, F.lit(of + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(judged)).otherwise(verdict)
    return rule, verdict


def _grams() -> Column:
    """Character n-grams of the marked host and path, told apart by a prefix."""
    parts = [("h", F.concat(F.lit("^"), "host", F.lit("$"))), ("p", F.concat("path", F.lit("$")))]
    return F.concat(*[_grams_of(mark, text, n) for mark, text in parts for n in GRAMS])


def _grams_of(mark: str, text: Column, n: int) -> Column:
    last = F.length(text) - (n - 1)
    starts = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1))))
    return F.transform(
        F.coalesce(starts, F.array().cast("array<int>")),
        lambda start: F.concat(F.lit(mark), F.substring(text, start, F.lit(n))),
    )


def judge(pages: DataFrame, rules=RULES, training_urls: int = TRAINING_URLS) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, and the method's ``p_block``."""
    rule, by_rule = rule_of(rules)
    parts = with_parts(pages.select("page_id", "url"))
    parts = parts.withColumns({"rule": rule, "by_rule": by_rule})
    known = parts.where("by_rule is not null").select("host", "path", "by_rule").distinct()
    labelled = bounded_sample(known, training_urls, "host", "path")
    seen = {row["by_rule"] for row in labelled.select("by_rule").distinct().collect()}
    judged = ["page_id", "host", "path", "rule"]
    if len(seen) < 2:
        only = next(iter(seen), "allow")
        return parts.select(
            *judged,
            F.coalesce("by_rule", F.lit(only)).alias("verdict"),
            F.lit(float(only == "block")).alias("p_block"),
        )
    hashing = HashingTF(
        numFeatures=FEATURES, binary=True, inputCol="_grams", outputCol="_features"
    )
    training = hashing.transform(
        labelled.select(
            _grams().alias("_grams"), (F.col("by_rule") == "block").cast("double").alias("_label")
        )
    )
    model = LogisticRegression(
        featuresCol="_features", labelCol="_label", regParam=PENALTY, maxIter=ITERATIONS
    ).fit(training)
    scored = model.transform(hashing.transform(parts.withColumn("_grams", _grams())))
    scored = scored.withColumn("p_block", vector_to_array("probability")[1])
    method = F.when(F.col("p_block") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(*judged, F.coalesce("by_rule", method).alias("verdict"), "p_block")
