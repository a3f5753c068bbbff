import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from haulrate.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = sentencepiece.SentencePieceProcessor(model_file=PATH)
VOCABULARY = pieces.read_vocabulary(PATH)
ENCODE, DECODE = pieces.codec(VOCABULARY)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab eéß日😀▁\n\t\x00.,'’12wSt​́") | st.characters(exclude_categories=["Cs"]), max_size=60))
def test_same_ids_and_text_as_the_library(text):
    ids = MODEL.encode(text)
    assert ENCODE(text) == ids
    assert DECODE(ids) == MODEL.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 31_999) | st.integers(3, 258), max_size=12))
def test_decodes_any_ids_like_the_library(ids):
    assert DECODE(ids) == MODEL.decode(ids)


def test_long_units_and_every_piece():
    for text in ("a" * 5_000, "thethethe" * 700, "😀" * 900, "=" * 3_000):
        assert ENCODE(text) == MODEL.encode(text)
    for piece in list(VOCABULARY.rank)[::7]:
        text = piece.replace(pieces.SPACE, " ")
        assert ENCODE(text) == MODEL.encode(text)


def test_table(spark, sf_dir, awkward):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    for df in (documents, awkward):
        texts = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in df.collect())
        rows = pieces.round_trip(df, PATH).collect()
        found = sorted(((r.doc_id is None, r.doc_id or 0), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows)
        expected = []
        for null, doc_id, text in texts:
            ids = MODEL.encode(text)
            digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), MODEL.decode(ids))]
            expected.append(((null, doc_id), len(ids), *digests))
        assert found == sorted(expected)
    assert pieces.round_trip(documents.limit(0), PATH).count() == 0


def test_refuses_other_models(tmp_path):
    with pytest.raises(Exception):
        pieces.read_vocabulary(str(tmp_path / "none.model"))


def test_a_worker_keeps_what_it_remembers_for_later_tasks():
    """One codec per vocabulary and process; another vocabulary gets its own."""
    vocabulary = pieces.read_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    usable = pieces.reachable(vocabulary.rank)
    kept = pieces.kept_codec(vocabulary, usable)
    again = pieces.Vocabulary(vocabulary.pieces, dict(vocabulary.rank), vocabulary.bytes, vocabulary.silent)
    assert pieces.kept_codec(again, list(usable)) is kept
    other = pieces.Vocabulary(vocabulary.pieces, vocabulary.rank, vocabulary.bytes, frozenset())
    assert pieces.kept_codec(other, usable) is not kept
