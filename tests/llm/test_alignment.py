import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from haulrate.llm import alignment

PATHS = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
A, B = alignment.sides(*PATHS)
LIBRARY = Tokenizer.from_file(PATHS[0])
LIBRARY.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def byte_of(char):
    """The byte behind a character of the byte-level vocabulary, found by encoding every byte."""
    return alignment.byte_level()[char]


def tokens_of(text):
    """(id, bytes) of each side, or nothing where they do not spell the text."""
    if not text:
        return [], []
    whole = f" {text}".encode()
    first = LIBRARY.encode(f" {text}", add_special_tokens=False)
    a = [(k, bytes(map(byte_of, token))) for k, token in zip(first.ids, first.tokens)]
    b = []
    for k in PIECES.encode(text):
        piece = PIECES.id_to_piece(k)
        b.append((k, bytes([int(piece[1:-1], 16)]) if PIECES.is_byte(k) else piece.replace("▁", " ").encode()))
    if any(b"".join(data for _, data in side) != whole for side in (a, b)):
        return [], []
    return a, b


def spans(tokens):
    at, out = 0, []
    for k, data in tokens:
        out.append((k, at, at + len(data)))
        at += len(data)
    return out


def brute_force(texts):
    """By every pair of spans, for texts by id."""
    out, counts, links_of = {}, Counter(), {}
    for key, text in texts:
        a, b = map(spans, tokens_of(text))
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        counts.update(links)
        links_of.setdefault(key, []).append(links)
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups = []
        for start, end in zip([0, *ends], ends):
            within = [",".join(str(k) for k, s, e in side if start <= s and e <= end) for side in (a, b)]
            groups.append("|".join(within))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.setdefault(key, []).append((len(a), len(b), len(groups), len(links), digest))
    most = defaultdict(int)
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    rows = []
    for key, found in out.items():
        for (n_a, n_b, n_groups, n_links, digest), links in zip(found, links_of[key]):
            best = sum(counts[link] == most[link[1]] for link in links)
            total = sum(counts[link] for link in links)
            rows.append((key, n_a, n_b, n_groups, n_links, best, total, digest))
    return sorted(rows, key=str)


def rows_of(df):
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((tuple(r[n] for n in names) for r in alignment.alignment(df, *PATHS).collect()), key=str)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*"ab eéßS'\n\t1,.(¼日😀▁\x00", "  ", "'ll", "<|endoftext|>", "</s>", "<0x41>", " the", "́", "Σ"]) | st.characters(exclude_categories=["Cs"]), max_size=14))
def test_ids_are_the_library_s(parts):
    text = "".join(parts)
    assert A.encode([text]) == [LIBRARY.encode(f" {text}", add_special_tokens=False).ids]
    made = alignment.align([text, "", "the end"], A, B)
    a, b = tokens_of(text)
    assert [made[n].to_pylist()[0] for n in ("n_a", "n_b")] == [len(a), len(b)]


def test_table(spark, sf_dir, docs, monkeypatch):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) < 4000").limit(60)
    texts = [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]
    texts += [(10_000 + k, "one hot passage, repeated") for k in range(200)]
    expected, df = brute_force(texts), docs(texts).repartition(4)
    assert rows_of(df) == expected
    for name, value in (("BROADCAST_PAIRS", 0), ("PAIRS_AT_ONCE", 50), ("CHARS_AT_ONCE", 500)):
        monkeypatch.setattr(alignment, name, value)
        assert rows_of(df) == expected


def test_awkward_rows(awkward, docs):
    long = [(1, None), (2, ""), (3, "mark ▁ here"), (4, "<|endoftext|></s>"), (5, "x" * 3000), (5, "x" * 3000), (None, "a\x00b")]
    df = docs(long).withColumns({n: F.lit("x") for n in ("row", "links", "pair", "n", "best", "n_best")})
    assert rows_of(df) == brute_force(long)
    rows = {r.doc_id: r for r in alignment.alignment(awkward, *PATHS).collect()}
    assert len(rows) == 9 and rows[6].n_a > 10_000 and rows[1].n_a == rows[2].count_sum == 0
    assert alignment.alignment(docs([]), *PATHS).count() == 0


def test_refuses_other_tokenizers():
    with pytest.raises(Exception):
        alignment.byte_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
