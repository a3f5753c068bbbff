import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from haulrate.llm.words import shingle_sets, word_hashes
from tests.llm.util import words

TEXTS = st.lists(
    st.none() | st.text(alphabet="aAbB \t\n\x0b\x85 éÉ\x00", max_size=40), max_size=8
)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_words_are_told_apart(texts):
    hashes, offsets = word_hashes(pa.array(texts, pa.string()))
    found = [words(text) for text in texts]
    assert [b - a for a, b in zip(offsets, offsets[1:])] == [len(w) for w in found]
    by_word = {}
    for word, value in zip((w for ws in found for w in ws), hashes.tolist()):
        assert by_word.setdefault(word, value) == value
    assert len(set(by_word.values())) == len(by_word)


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_shingles(texts):
    for text, shingles in zip(texts, shingle_sets(pa.array(texts, pa.string()), 3)):
        found = words(text)
        count = len({tuple(found[k : k + 3]) for k in range(len(found) - 2)}) if len(found) > 2 else bool(found)
        assert len(shingles) == count


def test_long_words_and_slices():
    texts = pa.array(["skip", "a" * 100_000 + " b", "a" * 100_000 + "c b", None, "A" * 100_000])
    hashes, offsets = word_hashes(texts.slice(1))
    assert offsets.tolist() == [0, 2, 4, 4, 5]
    assert hashes[0] == hashes[4] != hashes[2] and hashes[1] == hashes[3]
