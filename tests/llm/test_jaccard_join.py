import random
from collections import defaultdict

import numpy as np
import pytest

from haulrate.llm import jaccard_join
from tests.llm.util import near_copies, words


def _set(text):
    found = words(text)
    if not found:
        return frozenset()
    return frozenset(tuple(found[k : k + 5]) for k in range(max(1, len(found) - 4)))


def brute_force(pairs):
    """doc_id -> (set size, smallest id that links lead to), by comparing all pairs."""
    sets = {doc_id: _set(text) for doc_id, text in pairs}
    parent = {doc_id: doc_id for doc_id in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {doc_id: (len(sets[doc_id]), root(doc_id)) for doc_id in ids}


def _found(df, **options):
    rows = jaccard_join.near_duplicates(df, **options).collect()
    return {row.doc_id: (row.n_shingles, row.component_id) for row in rows}


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    texts = []
    for length, changes in ((60, 1), (60, 2), (120, 3), (30, 1), (200, 6)):
        texts += near_copies(rng, 25, length, changes)
    passage = " ".join(f"p{k}" for k in range(60))
    texts += [f"{passage} {' '.join(f't{n}x{k}' for k in range(n % 40))}" for n in range(40)]
    texts += ["one two", "ONE two", "one two three four five", "", None, " \n", "a", "A"]
    texts += texts[:10]
    rng.shuffle(texts)
    return list(enumerate(texts, start=100))


def test_against_all_pairs(docs, corpus):
    assert _found(docs(corpus)) == brute_force(corpus)


@pytest.mark.parametrize("hints", [0, 8])
def test_whatever_order_is_known(docs, corpus, hints):
    assert _found(docs(corpus), hints=hints) == brute_force(corpus)


def test_lists_in_parts(docs, corpus, monkeypatch):
    """Lists, blocks and groups of a few rows each, as very long lists are dealt."""
    monkeypatch.setattr(jaccard_join, "PART_ROWS", 4)
    monkeypatch.setattr(jaccard_join, "GROUP_SHINGLES", 300)
    monkeypatch.setattr(jaccard_join, "SHORT_LIST", 3)
    monkeypatch.setattr(jaccard_join, "LONG_LIST", 5)
    monkeypatch.setattr(jaccard_join, "COUNT_BLOCK", 500)
    monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", 0)
    assert _found(docs(corpus)) == brute_force(corpus)


def test_chain_of_links(docs):
    """Neighbours are similar, the ends are not: the links still join them."""
    row = [f"w{k}" for k in range(400)]
    pairs = [(k, " ".join(row[4 * k : 4 * k + 100])) for k in range(40)]
    expected = brute_force(pairs)
    assert {component for _, component in expected.values()} == {0}
    assert _found(docs(pairs)) == expected


def test_awkward_rows(awkward, docs):
    rows = jaccard_join.near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    by_id = {row.doc_id: row for row in rows}
    assert by_id[1].n_shingles == by_id[3].n_shingles == 0 and by_id[1].component_id == 1
    assert by_id[5].component_id == 4 and by_id[None].component_id is None
    kept = jaccard_join.keep_one_of_each(awkward)
    assert kept.columns == awkward.columns
    ids = [row.doc_id for row in kept.collect()]
    assert sorted(k for k in ids if k) == [1, 2, 3, 4, 6, 7, 8] and ids.count(None) == 1
    assert jaccard_join.near_duplicates(docs([])).count() == 0
    same = docs([(None, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f")])
    assert {row.component_id for row in jaccard_join.near_duplicates(same).collect()} == {3}


def test_bitmaps_never_promise_less():
    rng = np.random.default_rng(1)
    for a, b, common in ((100, 100, 80), (100, 900, 100), (5, 5, 5), (3000, 2500, 2000)):
        shared = rng.integers(0, 2**63, common).astype(np.uint64)
        x, y = (np.unique(np.append(shared, rng.integers(0, 2**63, n - common).astype(np.uint64))) for n in (a, b))
        differ = jaccard_join.differing_bits(jaccard_join.parity_bitmap(x), jaccard_join.parity_bitmap(y))
        assert differ <= len(np.setxor1d(x, y))


def test_components_of_any_graph(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 180)]
    edges += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    neighbours = defaultdict(set)
    for a, b in edges:
        neighbours[a].add(b)
        neighbours[b].add(a)
    expected = {}
    for start in sorted(neighbours):
        todo = [start]
        while todo:
            node = todo.pop()
            if node not in expected:
                expected[node] = start
                todo += neighbours[node]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    found = {row.node: row.component for row in jaccard_join.components(df).collect()}
    assert found == expected
