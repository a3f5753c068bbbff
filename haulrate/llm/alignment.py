"""Alignment of two tokenizers' tokens over the same text, in Arrow.

Each batch of texts is encoded by both, and everything after that is Arrow's work on flat columns:
the lists of ids are flattened beside the index of their text; cumulative sums of the tokens' byte
lengths, less what the texts before have, give each token's end; an Acero hash join on (text, end)
keys finds the ends that both share, which cut the text into groups. A full outer join on the same
keys, sorted, is the text cut at the ends of either; the next token of each side covers such a
stretch, so every stretch is one link, and there are no others.

Links are counted twice over. Each task counts its id pairs with ``Table.group_by``, and Spark merges
these partial counts into corpus-wide ones. Then the links, staged as packed pairs, meet the counts:
each document sums its links' counts and how many of them are the best for their second id.

Pairs are broadcast to the workers as sorted arrays only if counted and at most ``BROADCAST_PAIRS``;
otherwise documents send their distinct pairs to meet the counts in a shuffle join, whose partitions
of frequent pairs adaptive execution splits, and are summed again by row.

Defined cases: a null or empty text has no tokens, nor has one whose tokens of either side do not
spell it (such as one that holds the second tokenizer's mark for a space); then all numbers are 0 and
the digest is empty. Texts that hold a special token's name are plain text. Very long texts are
encoded whole; ties in counts are all best; repeated rows count each; null ids are kept; other columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from haulrate.llm.common import filled, once_per_process
from haulrate.sources.shared import staged

MARK = "▁"
#: Texts of a step: so many at most, and fewer if they are longer than so many characters together.
TEXTS_AT_ONCE, CHARS_AT_ONCE = 256, 1 << 20
#: A task's pairs are counted again once so many partial counts stand beside each other.
PAIRS_AT_ONCE = 1 << 21
BROADCAST_PAIRS = 4_000_000
#: Bytes of a text have to be fewer, so that a text and a place in it make one key.
TEXT_BITS = 40

_ALIGNED = (
    "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups_sha256 string, links binary"
)
_COUNTED = "pair bigint, n bigint"
_SUMMED = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
    "count_sum bigint, groups_sha256 string"
)


#: Fixed value: how the first tokenizer cuts a text before its merges.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: Characters of texts that the quicker encoder may take; checked when loaded.
USUAL = "\0-~\xa0-ſ‐-‧€"

Encode = Callable[[list[str]], list[list[int]]]


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones
    themselves, the others in order from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def byte_tokenizer(path: str) -> tuple[Encode, list[bytes]]:
    """The ids of a space and each text by a byte-level tokenizer file, and the bytes of each id.

    Texts of usual characters go to a quicker encoder of the same merges.
    """
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    vocabulary, byte_of = tokenizer.get_vocab(with_added_tokens=False), byte_level()
    spelled = {bytes(map(byte_of.__getitem__, token)): k for token, k in vocabulary.items()}
    quick = tiktoken.Encoding(
        "merges", pat_str=PATTERN, mergeable_ranks=spelled, special_tokens={}
    ).encode_ordinary
    usual = re.compile(f"[{USUAL}]*").fullmatch

    def of_library(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    for char in (c for c in map(chr, range(0x2100)) if usual(c)):
        probe = f" a{char}1{char} {char}{char}B'{char}\n {char}'s  {char} "
        if quick(probe) != of_library(probe):
            raise ValueError(f"{path} does not cut {probe!r} as assumed")

    def encode(texts: list[str]) -> list[list[int]]:
        return [quick(" " + t) if usual(t) else of_library(" " + t) for t in texts]

    by_id = [b""] * tokenizer.get_vocab_size()
    for token, k in spelled.items():
        by_id[k] = token
    return encode, by_id


def piece_tokenizer(path: str) -> tuple[Encode, list[bytes]]:
    """The ids of each text by a piece model, which adds the space, and the bytes of each id."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    by_id = []
    for k in range(model.get_piece_size()):
        piece = model.id_to_piece(k)
        as_byte = bytes([int(piece[1:-1], 16)]) if model.is_byte(k) else None
        by_id.append(as_byte or piece.replace(MARK, " ").encode())
    return lambda texts: model.encode(texts, num_threads=1), by_id


class Side:
    """One tokenizer: its ids of texts, and each id's bytes, their number, and it as a decimal."""

    def __init__(self, encode: Encode, by_id: list[bytes]):
        self.encode = encode
        self.bytes = pa.array(by_id, pa.binary())
        self.sizes = pa.array(map(len, by_id), pa.int64())
        self.decimals = pa.array(map(str, range(len(by_id))), pa.string())

    def spells(self, ids: list[list[int]], texts: list[bytes]) -> list[bool]:
        """Whether the bytes of each text's tokens are the text's."""
        lists = pa.array(ids, pa.list_(pa.int32()))
        tokens = pc.take(self.bytes, pc.list_flatten(lists))
        _, offsets, data = tokens.buffers()
        at = np.frombuffer(offsets, np.int32)[lists.offsets.to_numpy()]
        data = data.to_pybytes() if data else b""
        return [data[at[k] : at[k + 1]] == text for k, text in enumerate(texts)]

    def ends(self, ids: list[list[int]]) -> pa.Table:
        """Each token, with the key of its text and its end there."""
        lists = pa.array(ids, pa.list_(pa.int32()))
        tokens, text = pc.list_flatten(lists), pc.list_parent_indices(lists)
        total = pc.cumulative_sum(pc.take(self.sizes, tokens))
        before = np.concatenate([[0], total.to_numpy()])[lists.offsets.to_numpy()[:-1]]
        end = pc.subtract(total, pc.take(pa.array(before), text))
        key = pc.add(pc.multiply(text.cast(pa.int64()), 1 << TEXT_BITS), end)
        return pa.table({"key": key, "id": tokens})

    def groups(self, ids: pa.ChunkedArray, last: np.ndarray) -> pa.Array:
        """The ids of each group, joined; ``last`` marks the last token of each."""
        ends = np.concatenate([[0], np.flatnonzero(last) + 1]).astype(np.int32)
        decimals = pc.take(self.decimals, ids.combine_chunks())
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), decimals), ",")


def sides(byte_path: str, piece_path: str) -> tuple[Side, Side]:
    """Both tokenizers, read once in a worker."""
    return once_per_process(
        ("alignment", byte_path, piece_path),
        lambda: (Side(*byte_tokenizer(byte_path)), Side(*piece_tokenizer(piece_path))),
    )


def pair_type(a: Side, b: Side) -> str:
    """The narrowest number that holds an id pair, first id times second size plus second id."""
    return "<i4" if len(a.sizes) * len(b.sizes) < 1 << 31 else "<i8"


def align(texts: list[str], a: Side, b: Side) -> dict[str, pa.Array | list]:
    """The columns of ``_ALIGNED`` after the ids, for each text."""
    spelled = [f" {text}".encode() if text else b"" for text in texts]
    of_a, of_b = a.encode(texts), b.encode(texts)
    for side, ids in ((a, of_a), (b, of_b)):
        for k, good in enumerate(side.spells(ids, spelled)):
            if not good or not texts[k]:
                of_a[k] = of_b[k] = []
    left, right = a.ends(of_a), b.ends(of_b).rename_columns(["key", "other"])
    met = left.join(right, "key", join_type="full outer", use_threads=False)
    met = met.take(pc.sort_indices(met["key"])).combine_chunks()
    text = met["key"].to_numpy() >> TEXT_BITS
    in_a, in_b = (met[name].is_valid().to_numpy() for name in ("id", "other"))
    shared = in_a & in_b

    def per_text(rows: np.ndarray) -> np.ndarray:
        return np.bincount(rows, minlength=len(texts))

    def ends(numbers: np.ndarray) -> pa.Array:
        return pa.array(np.concatenate([[0], np.cumsum(numbers)]).astype(np.int32))

    n_groups, n_links = per_text(text[shared]), per_text(text)
    groups = pc.binary_join_element_wise(
        a.groups(left["id"], shared[in_a]), b.groups(right["other"], shared[in_b]), "|"
    )
    joined = pc.binary_join(pa.ListArray.from_arrays(ends(n_groups), groups), ";").to_pylist()
    # The next token of either side covers a stretch that ends within it.
    first, second = (pc.fill_null_backward(met[name]).to_numpy() for name in ("id", "other"))
    kind = pair_type(a, b)
    pairs = (first.astype(np.int64) * len(b.sizes) + second).astype(kind)
    width = np.dtype(kind).itemsize
    data = [None, ends(n_links * width).buffers()[1], pa.py_buffer(pairs.tobytes())]
    return {
        "n_a": pa.array(list(map(len, of_a)), pa.int64()),
        "n_b": pa.array(list(map(len, of_b)), pa.int64()),
        "n_groups": pa.array(n_groups, pa.int64()),
        "n_links": pa.array(n_links, pa.int64()),
        "groups_sha256": pa.array(
            [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in joined], pa.string()
        ),
        "links": pa.BinaryArray.from_buffers(pa.binary(), len(texts), data),
    }


def _steps(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that are aligned at once."""
    start = chars = 0
    for k, text in enumerate(texts):
        if k > start and (k - start == TEXTS_AT_ONCE or chars + len(text) > CHARS_AT_ONCE):
            yield start, k
            start, chars = k, 0
        chars += len(text)
    if start < len(texts):
        yield start, len(texts)


def aligned(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """Each document's numbers, the digest of its groups and its packed links, with a row id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = sides(byte_path, piece_path)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for start, stop in _steps(texts):
                made = align(texts[start:stop], a, b)
                columns = {
                    "row": pa.array(range(row, row + stop - start), pa.int64()),
                    "doc_id": batch.column("doc_id").slice(start, stop - start),
                } | made
                row += stop - start
                names = [part.split()[0] for part in _ALIGNED.split(", ")]
                yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

    return filled(docs).mapInArrow(run, _ALIGNED)


def _links(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The flat pairs of a binary column, and where each row's begin and end among them."""
    width = np.dtype(kind).itemsize
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, kind) if data and data.size else np.empty(0, kind)
    return flat[at[0] // width : at[-1] // width], (at - at[0]) // width


def pair_counts(links: DataFrame, kind: str, size_b: int) -> DataFrame:
    """How many links of the corpus hold each pair, and whether that is its second id's most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.table({"pair": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        for batch in batches:
            flat, _ = _links(batch.column("links"), kind)
            for start in range(0, len(flat), PAIRS_AT_ONCE):
                pairs = pa.table({"pair": flat[start : start + PAIRS_AT_ONCE].astype(np.int64)})
                counts = pairs.group_by("pair", use_threads=False).aggregate([([], "count_all")])
                held = pa.concat_tables([held, counts.rename_columns(["pair", "n"])])
                if held.num_rows > PAIRS_AT_ONCE:
                    held = _merged(held)
                if held.num_rows > PAIRS_AT_ONCE // 2:
                    yield from held.combine_chunks().to_batches(max_chunksize=1 << 16)
                    held = held.slice(0, 0)
        yield from _merged(held).combine_chunks().to_batches(max_chunksize=1 << 16)

    partial = links.select("links").mapInArrow(run, _COUNTED)
    counts = partial.groupBy("pair").agg(F.sum("n").alias("n"))
    counts = staged(counts.withColumn("second", F.col("pair") % size_b), "pair-counts")
    # One row for each id of the second vocabulary at most, so it may be broadcast.
    best = counts.groupBy("second").agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(best), "second").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best")
    )


def _merged(counts: pa.Table) -> pa.Table:
    merged = counts.group_by("pair", use_threads=False).aggregate([("n", "sum")])
    return merged.rename_columns(["pair", "n"])


def _summed_in_tasks(docs: DataFrame, counts: DataFrame, kind: str) -> DataFrame:
    """The sums, with all counts in every worker; for counts that were found to be few."""
    table = counts.toArrow().sort_by("pair")
    arrays = [table[name].to_numpy() for name in ("pair", "n", "best")]
    kept = docs.sparkSession.sparkContext.broadcast(arrays)
    names = [part.split()[0] for part in _SUMMED.split(", ")]

    def sums(numbers: np.ndarray, at: np.ndarray) -> pa.Array:
        total = np.concatenate([[0], np.cumsum(numbers, dtype=np.int64)])
        return pa.array(total[at[1:]] - total[at[:-1]], pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, numbers, best = kept.value
        for whole in batches:
            for start in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(start, TEXTS_AT_ONCE)
                flat, at = _links(batch.column("links"), kind)
                place = np.searchsorted(pairs, flat)
                made = {"n_best": sums(best[place], at), "count_sum": sums(numbers[place], at)}
                columns = [made[n] if n in made else batch.column(n) for n in names]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, _SUMMED)


def _summed_by_join(docs: DataFrame, counts: DataFrame, kind: str) -> DataFrame:
    """The same by a shuffle of each document's distinct pairs, for counts of any number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(start, TEXTS_AT_ONCE)
                flat, at = _links(batch.column("links"), kind)
                rows = np.repeat(batch.column("row").to_numpy(), np.diff(at))
                pairs = pa.table({"row": rows, "pair": flat.astype(np.int64)})
                found = pairs.group_by(["row", "pair"], use_threads=False)
                found = found.aggregate([([], "count_all")]).rename_columns(["row", "pair", "m"])
                yield from found.combine_chunks().to_batches()

    pairs = docs.select("row", "links").mapInArrow(run, "row bigint, pair bigint, m bigint")
    sums = pairs.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("n_best"),
        F.sum(F.col("m") * F.col("n")).alias("count_sum"),
    )
    nothing = F.lit(0).cast("bigint")
    return docs.drop("links").join(sums, "row", "left").select(
        *[
            F.coalesce(name, nothing).alias(name) if name in ("n_best", "count_sum") else name
            for name in (part.split()[0] for part in _SUMMED.split(", "))
        ]
    )


def alignment(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """Per document: tokens, groups, links, and its links' corpus-wide counts."""
    a, b = sides(byte_path, piece_path)
    kind = pair_type(a, b)
    found = staged(aligned(docs, byte_path, piece_path), "links")
    counts = staged(pair_counts(found, kind, len(b.sizes)), "best-counts")
    few = counts.count() <= BROADCAST_PAIRS
    return (_summed_in_tasks if few else _summed_by_join)(found, counts, kind)
