import os
import math
import zlib
from collections import Counter, defaultdict

import pytest

from haulrate.llm import language_model
from tests.llm.util import words


def plain_model(training):
    """Interpolated modified Kneser-Ney of order two, over dictionaries."""
    counts, pairs = Counter(), Counter()
    for text in training:
        tokens = [*words(text), "</s>"]
        counts.update(tokens)
        pairs.update(zip(["<s>", *tokens], tokens))
    follows = Counter(right for _, right in pairs)
    total, kinds = sum(counts.values()), len(counts)

    def discounts(values):
        n = Counter(min(value, 5) for value in values)
        if not n[1] or not n[2]:
            return [0, 0.5, 0.5, 0.5]
        y = n[1] / (n[1] + 2 * n[2])
        raw = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3] if n[3] else 1.5]
        return [0, *[min(max(d, 0.05), top) for d, top in zip(raw, (0.95, 1.95, 2.95))]]

    of_pairs, of_words = discounts(pairs.values()), discounts(follows.values())
    lead, kept = Counter(), defaultdict(float)
    for (left, _), n in pairs.items():
        lead[left] += n
        kept[left] += of_pairs[min(n, 3)]
    rest = sum(of_words[min(n, 3)] for n in follows.values()) / max(1, len(pairs)) if pairs else 1.0

    def lower(word):
        n = follows[word]
        return max(n - of_words[min(n, 3)], 0) / max(1, len(pairs)) + rest / (kinds + 1)

    def chance(left, right):
        if left not in lead:
            return lower(right)
        n = pairs.get((left, right), 0)
        return max(n - of_pairs[min(n, 3)], 0) / lead[left] + kept[left] / lead[left] * lower(right)

    def base(word):
        return (counts[word] + 0.5) / (total + 0.5 * (kinds + 1))

    return counts, chance, base


def _assert_same(df):
    texts = [(row.doc_id, row.text) for row in df.select("doc_id", "text").collect()]

    def held_out(doc_id):
        return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1

    counts, chance, base = plain_model([t for k, t in texts if not held_out(k)])
    rows = language_model.perplexities(df).collect()
    assert len(rows) == len(texts)
    expected = defaultdict(list)
    for doc_id, text in texts:
        tokens = [*words(text), "</s>"]
        score = sum(math.log10(chance(*pair)) for pair in zip(["<s>", *tokens], tokens))
        known = sum(token in counts for token in tokens)
        expected[doc_id].append((len(tokens), known, sum(math.log10(base(t)) for t in tokens), score))
    for row in rows:
        assert row.held_out == held_out(row.doc_id) and row.train_tokens == sum(counts.values())
        close = [
            (n, known) == (row.n_tokens, row.n_known)
            and row.base_score == pytest.approx(b, rel=1e-9, abs=1e-9)
            and row.score == pytest.approx(s, rel=1e-9, abs=1e-9)
            for n, known, b, s in expected[row.doc_id]
        ]
        assert any(close), row
    return rows


def test_table_against_dictionaries(spark, sf_dir):
    rows = _assert_same(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out)


def test_blocks_shards_and_large_counts(spark, docs, monkeypatch):
    monkeypatch.setattr(language_model, "BLOCK_TOKENS", 50)
    pairs = [(k, " ".join(f"w{(k * j) % 17}" for j in range(40))) for k in range(200)]
    pairs += [(1000 + k, "same words again " * 30) for k in range(20)]
    _assert_same(docs(pairs))


def test_awkward_rows(awkward):
    _assert_same(awkward)


def test_nothing_to_learn_from(docs):
    assert language_model.perplexities(docs([])).count() == 0
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 5 == 1)
    (row,) = _assert_same(docs([(held, "only held out words")]))
    assert row.score == 0 and row.base_score == 0 and row.n_known == 0


def test_chances_add_up(docs):
    counts, chance, _ = plain_model(["a b a b c", "a c d"])
    for left in ("a", "<s>", "never"):
        assert sum(chance(left, word) for word in [*counts, "unknown"]) == pytest.approx(1)


def test_an_absent_file_is_an_error(docs):
    df = docs([(k, f"a few words {k % 7} of text {k}") for k in range(60)])
    model = language_model.train(df)
    scorer = language_model.Scorer(model)
    os.rename(f"{model.folder}/{min(model.files)}", f"{model.folder}/gone.away")
    kind, shard = min(model.files).split("-")
    types = language_model._PAIR_TYPES if kind == "pairs" else language_model._WORD_TYPES
    with pytest.raises(FileNotFoundError):
        scorer._file({}, kind, int(shard), types)
    assert scorer._file({}, kind, model.shards + 1, types) is None
