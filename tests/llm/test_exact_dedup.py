import hashlib
from collections import defaultdict

import numpy as np
import pytest

from haulrate.llm import exact_dedup
from tests.llm.util import ascii_lower


def _expected(pairs):
    groups = defaultdict(list)
    for doc_id, text in pairs:
        groups[ascii_lower(text or "")].append(doc_id)
    named = {t: [k for k in ids if k is not None] for t, ids in groups.items()}
    return {t: (max(named[t], default=None), len(ids)) for t, ids in groups.items()}


def test_rows_against_brute_force(spark, docs):
    pairs = [(k, f"Text {k % 37}" if k % 3 else f"TEXT {k % 11}") for k in range(400)]
    pairs += [(900, None), (901, ""), (None, "text 1"), (977, "É"), (978, "é")]
    rows = exact_dedup.dedup_rows(docs(pairs)).collect()
    expected = _expected(pairs)
    text_of = dict((k, ascii_lower(t or "")) for k, t in pairs if k is not None)
    assert len(rows) == len(pairs)
    for row in rows:
        text = text_of[row.doc_id] if row.doc_id is not None else "text 1"
        assert (row.keep_id, row.group_size) == expected[text]
        assert row.kept == (row.doc_id is not None and row.doc_id == row.keep_id)
        assert row.text_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert any(row.in_history for row in rows) and not all(row.in_history for row in rows)


def test_awkward_rows(awkward):
    rows = exact_dedup.dedup_rows(awkward).collect()
    assert len(rows) == awkward.count()
    groups = defaultdict(list)
    for row in rows:
        groups[row.text_sha256].append(row)
    for group in groups.values():
        assert sum(row.kept for row in group) == 1
        assert {row.group_size for row in group} == {len(group)}
    kept = exact_dedup.keep_first_copies(awkward)
    assert kept.columns == awkward.columns
    assert kept.count() == len(groups)


@pytest.mark.parametrize("most", [200_000, 0])
def test_kept_rows_and_all_their_columns(docs, monkeypatch, most):
    monkeypatch.setattr(exact_dedup, "BROADCAST_COPIES", most)
    pairs = [(k, f"Text {k % 50}" if k % 3 else "hot TEXT") for k in range(600)]
    pairs += [(599, "text 49"), (599, "text 49"), (None, "hot text"), (None, "alone"), (None, "Alone")]
    df = docs(pairs).repartition(7)
    last = {}
    for doc_id, text in pairs:
        key = text.lower()
        last[key] = max(last.get(key, -1), -1 if doc_id is None else doc_id)
    kept = exact_dedup.keep_first_copies(df).collect()
    found = sorted((r.text.lower(), -1 if r.doc_id is None else r.doc_id) for r in kept)
    assert found == sorted(last.items())
    assert {r.lang for r in kept} == {"en"}


def test_empty_table(docs):
    assert exact_dedup.dedup_rows(docs([])).count() == 0
    assert exact_dedup.keep_first_copies(docs([])).count() == 0


@pytest.mark.parametrize("count", [1, 2, 1000, 20_000])
def test_perfect_hash(count):
    digests = [hashlib.sha256(str(k).encode()).digest() for k in range(count)]
    words = exact_dedup._matrix(digests)
    levels, slots = exact_dedup.perfect_hash(words)
    assert sorted(slots.tolist()) == list(range(count))
    assert (exact_dedup.find_slots(levels, words) == slots).all()
    strangers = exact_dedup._matrix([hashlib.sha256(b"no%d" % k).digest() for k in range(500)])
    found = exact_dedup.find_slots(levels, strangers)
    at = {int(slot): digest for slot, digest in zip(slots, digests)}
    assert not any(k >= 0 and at[k] == strangers[n].tobytes() for n, k in enumerate(found.tolist()))
    assert np.all(found < count)
