import random
import zlib
from collections import Counter, defaultdict
from itertools import chain

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from haulrate.llm import slack_packing, word_ids

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODE = word_ids.id_codec(word_ids.read_tokenizer(PATH))
MARKS = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'s", "'LL", "_'", "\x1c", "\xa0", "é"]


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [1]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from([*"ab Zé'_-\n\t1²9ÉßñTd<|>日😀İΣς½×ªµ\x00", *MARKS]) | st.characters(exclude_categories=["Cs"]), max_size=16))
def test_same_ids_as_the_library(parts):
    text = "".join(parts)
    assert np.frombuffer(ENCODE(text), "<u4").tolist() == library_ids(text)[:-1]


def closest_sum(counts, capacity):
    """Every sum that the pieces reach, one piece after the other."""
    sums = {0}
    for length in chain.from_iterable([k] * n for k, n in counts.items()):
        sums |= {s + length for s in sums if s + length <= capacity}
    return max(sums)


@pytest.mark.parametrize("seed", range(40))
def test_window_is_the_closest(seed):
    rng = random.Random(seed)
    capacity = rng.choice([16, 60, 128])
    step = rng.choice([1, 1, 3, 7])
    counts = Counter(step * rng.randrange(1, capacity // step) for _ in range(rng.randrange(1, 12)))
    best, taken = slack_packing.closest_window(counts, capacity)
    assert best == closest_sum(counts, capacity) == sum(k * n for k, n in taken.items())
    assert all(n <= counts[k] for k, n in taken.items())


@pytest.mark.parametrize("seed", range(60))
def test_plan_places_every_token_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([16, 64, 256])
    lengths = rng.sample(range(1, capacity), rng.randrange(1, 9))
    counts = {k: rng.choice([1, 2, 5, 300, 4000]) for k in lengths}
    plan = slack_packing.make_plan(dict(counts), capacity)
    filled = defaultdict(list)
    for length, n in counts.items():
        for number in range(n):
            at = 0
            for start, size, sequence, offset in slack_packing.place(plan, length, number):
                assert start == at and size > 0
                at += size
                filled[sequence].append((offset, size))
            assert at == length
    assert sorted(filled) == list(range(plan.sequences))
    sizes = []
    for pieces in filled.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        sizes.append(at)
    assert all(size == capacity or size & (size - 1) == 0 for size in sizes) and max(sizes) <= capacity
    assert len([size for size in sizes if size < capacity]) < capacity.bit_length()
    assert len(plan.uses) + len(plan.claims) < 200  # whatever the counts


def test_one_length_that_fits_no_window():
    plan = slack_packing.make_plan({1500: 10**9, 7: 1})
    assert plan.sequences == (1500 * 10**9 + 7) // 2048 + ((1500 * 10**9 + 7) % 2048).bit_count()
    assert len(plan.uses) + len(plan.donors) + len(plan.claims) < 30


def assert_packed(df, rows, capacity):
    texts = defaultdict(list)
    for row in df.select("doc_id", "text").collect():
        texts[row.doc_id].append(row.text)
    pieces, filled = defaultdict(Counter), defaultdict(list)
    for r in rows:
        pieces[r.doc_id][r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
        filled[r.sequence_id].append((r.offset, r.length))
    for sequence in filled.values():
        at = 0
        for offset, length in sorted(sequence):
            assert offset == at
            at += length
        assert at <= capacity and (at == capacity or at & (at - 1) == 0)
    assert set(pieces) == set(texts)
    for doc_id, found in pieces.items():
        assert sum(n * length for (_, length, _, _), n in found.items()) == sum(len(library_ids(t)) for t in texts[doc_id])
        if len(texts[doc_id]) > 1 and len(set(texts[doc_id])) > 1:
            continue
        ids = np.array(library_ids(texts[doc_id][0]), "<u4")
        covered = Counter()
        for (start, length, crc, tokens), n in found.items():
            assert tokens == len(ids) and zlib.crc32(ids[start : start + length].tobytes()) == crc
            covered.update({at: n for at in range(start, start + length)})
        assert len(covered) == len(ids) and set(covered.values()) == {len(texts[doc_id])}
    return filled


@pytest.mark.parametrize("capacity", [2048, 64])
def test_table(spark, sf_dir, capacity):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for rows in (df, df.repartition(5)):
        assert_packed(df, slack_packing.pack(rows, PATH, capacity).collect(), capacity)


def test_copies_of_a_length_that_fits_no_window(docs, monkeypatch):
    df = docs([(k, "seven words are in this short text" if k % 3 else f"a{k}") for k in range(90)])
    for most in (slack_packing.BROADCAST_PIECES, 0):
        monkeypatch.setattr(slack_packing, "BROADCAST_PIECES", most)
        rows = slack_packing.pack(df.repartition(4), PATH, 32).collect()
        assert any(row.start for row in rows)
        assert_packed(df, rows, 32)


def test_awkward_rows(awkward, docs):
    df = awkward.withColumns({name: awkward["lang"] for name in ("rest", "part", "nth", "ids_crc32")})
    assert_packed(awkward, slack_packing.pack(df, PATH).collect(), slack_packing.CAPACITY)
    assert slack_packing.pack(docs([]), PATH).count() == 0


def test_refuses_other_tokenizers():
    with pytest.raises(ValueError):
        word_ids.read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
