import math
import random
from collections import Counter, defaultdict

import pytest

from haulrate.llm import packing
from tests.llm.util import ascii_lower, words


def plain_pack(items, capacity, per_source):
    """Best fit by looking at every bin: the tightest compatible one, the oldest of equals."""
    bins, where = [], []
    for length, source, cluster in items:
        fitting = [
            (b["room"], k)
            for k, b in enumerate(bins)
            if b["room"] >= length and b["sources"][source] < per_source and cluster not in b["clusters"]
        ]
        if fitting:
            k = min(fitting)[1]
        else:
            k = len(bins)
            bins.append({"room": capacity, "sources": Counter(), "clusters": set()})
        bins[k]["room"] -= length
        bins[k]["sources"][source] += 1
        bins[k]["clusters"].add(cluster)
        where.append(k)
    return where


@pytest.mark.parametrize("seed", range(8))
def test_same_bins_as_brute_force(seed):
    rng = random.Random(seed)
    rows = [
        (k, rng.randrange(1, 101), f"s{min(rng.randrange(6), 2)}", b"%d" % rng.randrange(40))
        for k in range(300)
    ]
    placed = packing.pack_rows(rows, 100, 3)
    order = sorted(rows, key=lambda row: (-row[1], row[0]))
    expected = plain_pack([row[1:] for row in order], 100, 3)
    assert [(p[0], p[4]) for p in placed] == [(row[0], k) for row, k in zip(order, expected)]


def _assert_valid(df, rows, capacity, per_source):
    texts = defaultdict(list)
    for doc in df.collect():
        texts[doc.doc_id].append(doc)
    pieces, filled = defaultdict(list), Counter()
    sources, clusters = Counter(), Counter()
    for row in rows:
        pieces[row.doc_id].append(row)
        filled[row.bin_id] += row.n_tokens
        if row.n_tokens < capacity:
            doc = texts[row.doc_id][0]
            sources[row.bin_id, doc.source] += 1
            clusters[row.bin_id, ascii_lower(doc.text or "")] += 1
    assert max(filled.values()) <= capacity
    assert max(sources.values()) <= per_source and max(clusters.values()) == 1
    for doc_id, copies in texts.items():
        length = len(words(copies[0].text)) + 1
        assert len(pieces[doc_id]) == len(copies) * math.ceil(length / capacity)
        assert sum(row.n_tokens for row in pieces[doc_id]) == len(copies) * length
        starts = sorted(row.first_token for row in pieces[doc_id])
        assert starts == sorted(len(copies) * list(range(0, length, capacity)))
    return filled


def test_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = packing.pack(df, capacity=512).collect()
    filled = _assert_valid(df, rows, 512, packing.PER_SOURCE)
    assert sum(filled.values()) / (512 * len(filled)) > 0.75
    again = packing.pack(df.repartition(7), capacity=512).collect()
    assert sorted(again) == sorted(rows)


def test_hot_source_and_cluster(docs):
    pairs = [(k, "same text" if k % 3 else f"text {k} of many words") for k in range(600)]
    df = docs(pairs, source=None)
    _assert_valid(df, packing.pack(df, capacity=64, per_source=4).collect(), 64, 4)


def test_awkward_rows(awkward, docs):
    rows = packing.pack(awkward).collect()
    _assert_valid(awkward, rows, packing.CAPACITY, packing.PER_SOURCE)
    assert packing.pack(docs([])).count() == 0
