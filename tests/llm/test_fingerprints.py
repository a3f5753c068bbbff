import hashlib
import random

import pytest

from haulrate.llm import fingerprints
from tests.llm.util import near_copies

GEAR = fingerprints.gear_table()


def plain_chunks(text):
    """Chunks found byte by byte, with a hash that starts anew at each chunk."""
    data, chunks, start = text.encode(), [], 0
    gear = GEAR.tolist()
    while start < len(data):
        value, end = 0, len(data)
        for at in range(start, len(data)):
            value = ((value << 1) + gear[data[at]]) & 0xFFFFFFFF
            size = at + 1 - start
            if size < fingerprints.LEAST:
                continue
            bits = fingerprints.STRICT_BITS if size < fingerprints.NORMAL else fingerprints.LOOSE_BITS
            if value >> (32 - bits) == 0 or size >= fingerprints.MOST:
                end = at + 1
                break
        chunks.append(data[start:end])
        start = end
    return chunks


def plain_fingerprint(text):
    found = {}
    for chunk in plain_chunks(text):
        key = hashlib.blake2b(chunk, digest_size=fingerprints.DIGEST_BYTES).hexdigest(), len(chunk)
        found[key] = found.get(key, 0) + 1
    return found


def test_chunks_against_a_loop_over_bytes():
    rng = random.Random(2)
    texts = ["", "a", "x" * 31, "x" * 32, "x" * 1000, "é" * 700]
    texts += ["".join(rng.choice("abcdef éß😀\n") for _ in range(n)) for n in (33, 64, 200, 4000)]
    assert fingerprints.chunk_counts(texts, GEAR) == [plain_fingerprint(text) for text in texts]


def _assert_rows(df):
    rows = fingerprints.fingerprint(df).collect()
    ordered = sorted(((r.doc_id, r.text or "") for r in df.collect()), reverse=True)
    found = {row.doc_id: row for row in rows}
    assert len(rows) == len(ordered) == len(found)
    for k, (doc_id, text) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        own, other = plain_fingerprint(text), plain_fingerprint(edited)
        row = found[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.fingerprint == fingerprints.written(own)
        assert row.edited_fingerprint == fingerprints.written(other)
        assert row.near_edited == fingerprints.likeness(own, other)
        assert row.near_next == fingerprints.likeness(own, plain_fingerprint(following))


def test_pairs_of_rows_across_ranges(docs, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 7)
    monkeypatch.setattr(fingerprints, "BLOCK_CHARS", 900)
    rng = random.Random(4)
    texts = near_copies(rng, 30, 60, 2) + ["", None, "short", "é" * 50, "y" * 5000]
    ids = rng.sample(range(-500, 500), len(texts))
    _assert_rows(docs(list(zip(ids, texts))))
    _assert_rows(docs([(1, "alone " * 50)]))
    _assert_rows(docs([(1, "two " * 50), (2, None)]))


def test_shifted_copies_stay_alike():
    rng = random.Random(6)
    text = " ".join(f"word{rng.randrange(10**6)}" for _ in range(600))
    moved, near = "inserted here: " + text, text.replace("word", "WORD", 1)
    a, b, c = fingerprints.chunk_counts([text, moved, near], GEAR)
    assert fingerprints.likeness(a, b) > 0.95 and fingerprints.likeness(a, c) > 0.95
    (half,) = fingerprints.chunk_counts([text[: len(text) // 2]], GEAR)
    assert fingerprints.containment(half, a) > 0.9 and fingerprints.containment(a, half) < 0.6
    assert fingerprints.likeness(a, a) == 1.0


def test_awkward_rows(awkward, docs):
    rows = fingerprints.fingerprint(awkward).collect()
    assert len(rows) == awkward.count()
    assert all(0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1 for row in rows)
    assert len({row.fingerprint for row in rows if row.doc_id == 5}) == 1
    assert [row.near_next for row in rows if row.doc_id == 2] == [1.0]
    assert fingerprints.fingerprint(docs([])).count() == 0


@pytest.mark.parametrize("text", ["", "é", "abc", "😀" * 10])
def test_edited_text(text):
    third = len(text) // 3
    assert fingerprints.edited_text(text, "zy") == text[: len(text) - third] + "zy"[:third]
