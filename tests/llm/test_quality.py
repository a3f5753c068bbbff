import numpy as np

from haulrate.llm import quality


def test_estimate_finds_unequal_labellers():
    """Votes drawn from known rates: the posterior separates the classes, false alarms are seen."""
    rng = np.random.default_rng(1)
    labellers = len(quality.LABELLERS)
    truth = rng.random(20_000) < 0.85
    kind = rng.integers(0, 4, len(truth))  # bad documents are of one kind each
    votes = np.ones((len(truth), labellers), np.int64)
    for k in range(4):
        votes[~truth & (kind == k), k] = 2
    votes[rng.random(votes.shape) < 0.05] = 0
    patterns, counts = np.unique(votes @ quality.VOTES ** np.arange(labellers), return_counts=True)
    posterior, emit, good = quality.estimate(patterns, counts.astype(float))
    place = np.searchsorted(patterns, votes @ quality.VOTES ** np.arange(labellers))
    assert ((posterior[place] >= 0.5) == truth).mean() > 0.98
    assert abs(good - 0.85) < 0.03
    assert np.allclose(emit.sum(axis=2), 1) and emit[1, :, 2].max() <= quality.FALSE_ALARMS + 1e-9
    assert emit[0, :4, 2].min() > 0.1


def test_estimate_of_nothing():
    posterior, _, good = quality.estimate(np.array([], np.int64), np.array([]))
    assert len(posterior) == 0 and 0 < good < 1


def test_table_against_true_labels(spark):
    """True quality labels, which the scorer never sees."""
    sf_dir = "/root/testdata/sf0.1"
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    scored = quality.judge(documents)
    assert scored.count() == documents.count()
    rows = scored.join(labels, "doc_id").collect()
    good = [row.kept for row in rows if row.quality == 1]
    bad = [row.kept for row in rows if row.quality == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.35
    assert all(row.kept == (row.score >= 0.5) == bool(row.predicted) for row in rows)


def test_awkward_rows(awkward, docs):
    rows = quality.judge(awkward).collect()
    assert len(rows) == awkward.count() and all(0 <= row.score <= 1 for row in rows)
    assert quality.judge(docs([])).count() == 0
    same = quality.judge(docs([(k, "a plain text of some words") for k in range(30)])).collect()
    assert len({row.score for row in same}) == 1
