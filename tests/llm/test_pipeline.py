"""The pipeline against plain Python over the same rows, and the registered queries."""

import duckdb
import pytest

import corpus_pipeline
from haulrate.llm import catalog, packing, secret_scan, toxicity
from tests.llm.test_jaccard_join import brute_force
from tests.llm.util import ascii_lower, words


def _expected(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(documents, labels)
    toxic = {row.doc_id for row in toxicity.score(documents, model).collect() if row.predicted}
    rows = [row for row in documents.collect() if row.doc_id not in toxic]
    last = {}
    for row in sorted(rows, key=lambda row: row.doc_id):
        last[ascii_lower(row.text or "")] = row
    groups = brute_force([(row.doc_id, row.text) for row in last.values()])
    kept = [row for row in last.values() if groups[row.doc_id][1] == row.doc_id]
    return {row.doc_id: (row, secret_scan._without(row.text or "", "[SECRET]")) for row in kept}, toxic


def test_stages(spark, sf_dir):
    expected, toxic = _expected(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == columns, name
    rows = docs.collect()
    assert {row.doc_id for row in rows} == set(expected) and len(rows) == len(expected)
    assert toxic and len(expected) < docs.sparkSession.read.parquet(f"{sf_dir}/documents.parquet").count()
    for row in rows:
        before, text = expected[row.doc_id]
        assert row.text == text and (row.lang, row.source) == (before.lang, before.source)


def test_run(spark, sf_dir):
    expected, _ = _expected(spark, sf_dir)
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    lengths = {}
    for row in rows:
        lengths[row.doc_id] = lengths.get(row.doc_id, 0) + row.n_tokens
    assert lengths == {k: len(words(text)) + 1 for k, (_, text) in expected.items()}
    bins = {}
    for row in rows:
        bins.setdefault(row.bin_id, []).append(row)
    assert all(sum(row.n_tokens for row in b) <= packing.CAPACITY for b in bins.values())


def test_stages_on_awkward_rows(spark, awkward, sf_dir):
    for docs in (awkward, awkward.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf_dir)
            if name != "best_fit_packing":
                assert docs.columns == awkward.columns
        docs.collect()


def test_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "ngram_jaccard_join", "secret_scans", "best_fit_packing",
    ]
    assert sorted(int(name[2:].split("_")[0]) for name in catalog.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", catalog.ORACLE_SQL)
def test_oracles(name, spark, sf_dir):
    duck = duckdb.connect()
    for table in ("documents", "pages", "labels"):
        duck.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    df = catalog.QUERIES[name](spark, sf_dir)
    relation = duck.sql(catalog.ORACLE_SQL[name])
    assert sorted(relation.columns) == sorted(df.columns)
    found = [tuple(row) for row in df.select(*relation.columns).collect()]
    assert sorted(found) == sorted(relation.fetchall())
