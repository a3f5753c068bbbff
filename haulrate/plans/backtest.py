"""The back-test as a job: price all shipments, save them, and report the scorecard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from haulrate.operators.evaluate import evaluation_summary
from haulrate.params import Params
from haulrate.plans.pricing import detail, price
from haulrate.sources.cards import Cards
from haulrate.sources.facts import load_facts


def run(
    spark: SparkSession, facts_dir: str, cards_dir: str, out_dir: str, p: Params
) -> tuple[DataFrame, DataFrame]:
    """Write the priced shipments and return them with their scorecard.

    Both results come from the written table, so the chain is computed once.
    """
    cards, facts = Cards.load(spark, cards_dir, p.limits), load_facts(spark, facts_dir)
    facts.check_keys()
    priced = detail(price(facts, cards, p), p)
    priced.write.mode("overwrite").parquet(out_dir)
    saved = spark.read.parquet(out_dir)
    return saved, evaluation_summary(saved)
