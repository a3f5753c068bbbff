"""Perplexity under an interpolated modified Kneser-Ney bigram model.

Counting is one Spark job of two shuffles. Tasks over the training texts reduce blocks of tokens to
distinct words and word pairs, and send them as packed arrays of hashes to shards. The tasks of the
first shuffle add up their pairs, write them to the shared folder as one file of sorted hash
arrays, and send on what each pair adds to its words: how many words a word follows, and how many
words follow it once, twice or more often. The tasks of the second shuffle add that up and write a
file of sorted words. Scoring tasks map the files into memory (the pages are the system's, shared
by all workers of a machine) and look up batches of hashes by binary search.

A shard holds a sixteenth of the followers of a word, so a word that a third of all pairs begin
with is spread over sixteen tasks, after blocks have reduced it to distinct pairs. Files are
written under another name first and then renamed, so a task that runs again replaces its own file.
The folder in ``spark.checkpoint.dir`` has to be a mounted path that all executors see.

Words are 64-bit hashes; in pairs they are cut to 48 bits, and 48 bits of a pair's hash are kept
within its shard. Counts are whole and cover all training texts.

Defined cases: a null or empty text is one end mark. If nothing is held in, every token has the
probability 1 of the only class there is. Null ids are held in. Repeated rows count and score
each; texts are read whole, other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulrate.llm.common import filled, in_fold
from haulrate.llm.words import mix, word_hashes
from haulrate.sources.shared import shared_folder

BLOCK_TOKENS = 1 << 21
SPREAD = 16
#: Texts that a shard is made of on average, and the most files of each kind.
SHARD_ROWS = 4096
MOST_SHARDS = 20_000
SMALL = 255
END = np.uint64(0x5DEECE66D1234567)
START = np.uint64(0x2545F4914F6CDD1D)
_CUT = np.uint64(16)
_JOIN = np.uint64(0xD6E8FEB86659FD93)

PACKED = "shard int, kind int, data binary"
WORDS, PAIRS, FOLLOWED, FOLLOWERS, TOTALS = range(5)
_PACKED = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())])
TOTAL_NAMES = ("tokens", "words", "pairs", "p1", "p2", "p3", "p4", "w1", "w2", "w3", "w4", "w3up")
TOTAL_NAMES += ("pair_files", "word_files")


@dataclass
class Model:
    """Where the arrays are, and the totals that probabilities need."""

    folder: str
    shards: int
    totals: dict[str, int]
    files: frozenset[str]

    def discounts(self, mark: str) -> np.ndarray:
        """What is taken from counts 0, 1, 2 and 3 or more."""
        n1, n2, n3, n4 = (self.totals[f"{mark}{k}"] for k in (1, 2, 3, 4))
        if not n1 or not n2:
            return np.array([0.0, 0.5, 0.5, 0.5])
        y = n1 / (n1 + 2 * n2)
        three = 3 - 4 * y * n4 / n3 if n3 else 1.5
        found = np.array([0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, three])
        return np.clip(found, [0, 0.05, 0.05, 0.05], [0, 0.95, 1.95, 2.95])


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, byte by byte, so that leading zero bytes lie together."""
    parts = [a.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for a in arrays]
    return b"".join(parts)


def unpacked(data: bytes, count: int) -> list[np.ndarray]:
    planes = np.frombuffer(data, np.uint8).reshape(count, 8, -1)
    return [np.ascontiguousarray(p.T).view("<u8").ravel() for p in planes]


def _steps(rising: np.ndarray) -> np.ndarray:
    return np.diff(rising, prepend=np.uint64(0))


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word before, word) of every token, each text closed by an end mark; the texts' offsets."""
    words, offsets = word_hashes(texts)
    tokens = np.insert(words, offsets[1:], END)
    offsets = offsets + np.arange(len(offsets))
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[offsets[:-1]] = START
    return before, tokens, offsets


def _word_shard(words: np.ndarray, shards: int) -> np.ndarray:
    """Ranges of the 48-bit words."""
    return ((words >> np.uint64(16)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


def _pair_shard(left: np.ndarray, right: np.ndarray, shards: int) -> np.ndarray:
    spread = mix(left + (right % np.uint64(SPREAD)) * _JOIN)
    return (spread % np.uint64(shards)).astype(np.int32)


def _pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * _JOIN + mix(right))


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys rising, the sum of each one's counts, and one place where each stands."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(keys)])
    if not len(starts):
        return keys[:0], counts[:0], order
    return ordered[starts], np.add.reduceat(counts[order], starts), order[starts]


def _by_shard(shard: np.ndarray, count: int) -> Iterator[tuple[int, slice]]:
    """Slices of rows that are sorted by shard."""
    ends = np.searchsorted(shard, np.arange(count + 1))
    for k in np.unique(shard).tolist():
        yield k, slice(ends[k], ends[k + 1])


def _rows(found: list[tuple[int, int, bytes]]) -> pa.Table:
    columns = list(zip(*found)) or [[], [], []]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _PACKED)], schema=_PACKED)


def _block(before: np.ndarray, tokens: np.ndarray, shards: int) -> list[tuple[int, int, bytes]]:
    """A block's distinct words and pairs with their counts, packed for each shard."""
    out = []
    ones = np.ones(len(tokens), np.int64)
    words, counts, _ = _summed(tokens, ones)
    for k, part in _by_shard(_word_shard(words >> _CUT, shards), shards):
        out.append((k, WORDS, packed(_steps(words[part]), counts[part])))
    left, right = before >> _CUT, tokens >> _CUT
    _, counts, at = _summed(_pair_hash(left, right), ones)
    left, right = left[at], right[at]
    shard = _pair_shard(left, right, shards)
    order = np.lexsort((left, shard))
    left, right, counts, shard = left[order], right[order], counts[order], shard[order]
    for k, part in _by_shard(shard, shards):
        data = packed(_steps(left[part]), right[part], counts[part])
        out.append((k, PAIRS, data))
    return out


def _write(path: str, *arrays: np.ndarray) -> None:
    """One file: the arrays' lengths, then the arrays, each from a multiple of eight bytes."""
    draft = f"{path}.{uuid.uuid4().hex}"
    with open(draft, "wb") as out:
        out.write(np.array([len(a) for a in arrays], "<i8").tobytes())
        for array in arrays:
            out.write(array.tobytes())
            out.write(b"\0" * (-array.nbytes % 8))
    os.replace(draft, path)


def _mapped(path: str, *types: str) -> list[np.ndarray]:
    data = np.memmap(path, np.uint8, "r")
    lengths, at, arrays = data[: 8 * len(types)].view("<i8"), 8 * len(types), []
    for length, type_ in zip(lengths.tolist(), types):
        size = length * np.dtype(type_).itemsize
        arrays.append(data[at : at + size].view(type_))
        at += size + -size % 8
    return arrays


_PAIR_TYPES = ("<u4", "<u2", "u1", "<i8", "<i8")
_WORD_TYPES = ("<u8", "<i8", "<i8", "<i8")


def _merge_pairs(folder: str, shards: int):
    def run(rows: pa.Table) -> pa.Table:
        shard, out = rows.column("shard")[0].as_py(), []
        kinds, data = rows.column("kind").to_numpy(), rows.column("data")
        blocks = [unpacked(data[int(k)].as_py(), 2) for k in np.flatnonzero(kinds == WORDS)]
        if blocks:
            words = np.concatenate([np.cumsum(steps, dtype=np.uint64) for steps, _ in blocks])
            words, counts, _ = _summed(words, np.concatenate([n for _, n in blocks]).astype("i8"))
            out.append((shard, WORDS, packed(_steps(words), counts)))
        blocks = [unpacked(data[int(k)].as_py(), 3) for k in np.flatnonzero(kinds == PAIRS)]
        if not blocks:
            return _rows(out)
        left = np.concatenate([np.cumsum(steps, dtype=np.uint64) for steps, _, _ in blocks])
        right = np.concatenate([right for _, right, _ in blocks])
        counts = np.concatenate([n for _, _, n in blocks]).astype(np.int64)
        del blocks
        hashes, counts, at = _summed(_pair_hash(left, right), counts)
        left, right = left[at], right[at]
        big = np.flatnonzero(counts >= SMALL)
        _write(
            f"{folder}/pairs-{shard}",
            (hashes >> np.uint64(32)).astype("<u4"),
            (hashes >> np.uint64(16)).astype("<u2"),
            np.minimum(counts, SMALL).astype("u1"),
            big.astype("<i8"),
            counts[big].astype("<i8"),
        )
        followed, n, _ = _summed(right, np.ones(len(right), np.int64))
        for k, part in _by_shard(_word_shard(followed, shards), shards):
            out.append((k, FOLLOWED, packed(_steps(followed[part]), n[part])))
        words, ones, _ = _summed(left, (counts == 1).astype(np.int64))
        twos = _summed(left, (counts == 2).astype(np.int64))[1]
        more = _summed(left, (counts > 2).astype(np.int64))[1]
        for k, part in _by_shard(_word_shard(words, shards), shards):
            data = packed(_steps(words[part]), ones[part], twos[part], more[part])
            out.append((k, FOLLOWERS, data))
        of = np.bincount(np.minimum(counts, 5), minlength=6)
        out.append((shard, TOTALS, np.array([len(counts), *of[1:5]], "<i8").tobytes()))
        return _rows(out)

    return run


def _merge_words(folder: str):
    """A shard of words: counts, how many words each follows, and what follows it."""

    def run(rows: pa.Table) -> pa.Table:
        shard, kinds = rows.column("shard")[0].as_py(), rows.column("kind").to_numpy()
        data = rows.column("data")

        def blocks(kind: int, columns: int) -> tuple[np.ndarray, list[np.ndarray]]:
            found = [unpacked(data[int(k)].as_py(), columns) for k in np.flatnonzero(kinds == kind)]
            if not found:
                return np.empty(0, np.uint64), [np.empty(0, np.int64)] * (columns - 1)
            keys = np.concatenate([np.cumsum(block[0], dtype=np.uint64) for block in found])
            values = [
                _summed(keys, np.concatenate([b[c] for b in found]).astype("i8"))[1]
                for c in range(1, columns)
            ]
            return np.unique(keys), values

        words, (counts,) = blocks(WORDS, 2)
        followed, (times,) = blocks(FOLLOWED, 2)
        leading, followers = blocks(FOLLOWERS, 4)
        short = np.unique(np.concatenate([words >> _CUT, leading]))
        held = np.zeros((3, len(short)), np.int64)
        held[:, np.searchsorted(short, leading)] = followers
        follows = np.zeros(len(short), np.int64)
        follows[np.searchsorted(short, followed)] = times
        _write(
            f"{folder}/words-{shard}",
            words,
            counts,
            short.view(np.int64),
            np.concatenate([follows, held.ravel()]),
        )
        of = np.bincount(np.minimum(times, 5), minlength=6)
        totals = np.zeros(len(TOTAL_NAMES), np.int64)
        totals[:2] = counts.sum(), len(words)
        totals[7:12] = *of[1:5], (times > 2).sum()
        totals[12:] = (kinds == TOTALS).sum(), 1
        for k in np.flatnonzero(kinds == TOTALS):
            totals[2:7] += np.frombuffer(data[int(k)].as_py(), "<i8")
        return pa.table([[int(x)] for x in totals], names=list(TOTAL_NAMES))

    return run


def _folder(spark: SparkSession) -> str:
    path = shared_folder(spark, "model")
    local = path.removeprefix("file://").removeprefix("file:")
    if not local.startswith("/"):
        raise ValueError(f"spark.checkpoint.dir has to be a mounted folder, not {path}")
    os.makedirs(local, exist_ok=True)
    return local


def train(docs: DataFrame) -> Model:
    """Counts all texts of ``docs`` and writes the arrays to the shared folder."""
    spark = docs.sparkSession
    folder, least = _folder(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = min(MOST_SHARDS, max(least, docs.count() // SHARD_ROWS))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                before, tokens, _ = token_hashes(batch.column("text").slice(start, 256))
                held.append((before, tokens))
                size += len(tokens)
                if size >= BLOCK_TOKENS:
                    block = [np.concatenate(x) for x in zip(*held)]
                    yield from _rows(_block(*block, shards)).to_batches()
                    held, size = [], 0
        if held:
            block = [np.concatenate(x) for x in zip(*held)]
            yield from _rows(_block(*block, shards)).to_batches()

    pairs = filled(docs).select("text").mapInArrow(count, PACKED)
    merged = pairs.groupBy("shard").applyInArrow(_merge_pairs(folder, shards), PACKED)
    names = ", ".join(f"{name} bigint" for name in TOTAL_NAMES)
    totals = merged.groupBy("shard").applyInArrow(_merge_words(folder), names)
    sums = totals.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in TOTAL_NAMES]).first()
    files = frozenset(name for name in os.listdir(folder) if "." not in name)
    for kind in ("pair", "word"):
        written = sum(name.startswith(f"{kind}s-") for name in files)
        if written != sums[f"{kind}_files"]:
            raise RuntimeError(
                f"the driver sees {written} of {sums[f'{kind}_files']} {kind} files in {folder}: "
                "spark.checkpoint.dir has to be mounted by the driver and all executors"
            )
    return Model(folder, shards, sums.asDict(), files)


class Scorer:
    """Looks up words and pairs in the mapped arrays."""

    def __init__(self, model: Model):
        self._model = model
        self._pairs: dict[int, list[np.ndarray] | None] = {}
        self._words: dict[int, list[np.ndarray] | None] = {}
        self._pair_cut, self._word_cut = model.discounts("p"), model.discounts("w")

    def _file(self, held: dict, kind: str, shard: int, types: tuple) -> list[np.ndarray] | None:
        if shard not in held:
            # A shard that training wrote and this task cannot see is an error, no empty shard.
            name = f"{kind}-{shard}"
            there = name in self._model.files
            held[shard] = _mapped(f"{self._model.folder}/{name}", *types) if there else None
        return held[shard]

    def pair_counts(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        shard = _pair_shard(left, right, self._model.shards)
        hashes = _pair_hash(left, right)
        order = np.lexsort((hashes, shard))
        found = np.zeros(len(left), np.int64)
        for k, part in _by_shard(shard[order], self._model.shards):
            arrays = self._file(self._pairs, "pairs", k, _PAIR_TYPES)
            if arrays is None or not len(arrays[0]):
                continue
            high, low, counts, big_at, big = arrays
            where = order[part]
            wanted = hashes[where]
            wanted_high = (wanted >> np.uint64(32)).astype(np.uint32)
            wanted_low = (wanted >> np.uint64(16)).astype(np.uint16)
            at = np.searchsorted(high, wanted_high)
            todo = np.flatnonzero(at < len(high))
            while len(todo):  # entries of equal high bits stand together
                todo = todo[high[at[todo]] == wanted_high[todo]]
                same = low[at[todo]] == wanted_low[todo]
                hit = todo[same]
                n = counts[at[hit]].astype(np.int64)
                large = n == SMALL
                n[large] = big[np.searchsorted(big_at, at[hit][large])]
                found[where[hit]] = n
                todo = todo[~same]
                at[todo] += 1
                todo = todo[at[todo] < len(high)]
        return found

    def word_values(self, words: np.ndarray) -> np.ndarray:
        """For rising words: count, words it follows, words that follow it once, twice, more."""
        found = np.zeros((5, len(words)), np.int64)
        shards = self._model.shards
        for k, part in _by_shard(_word_shard(words >> _CUT, shards), shards):
            arrays = self._file(self._words, "words", k, _WORD_TYPES)
            if arrays is None:
                continue
            keys, counts, short, values = arrays
            wanted = words[part]
            if len(keys):
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                found[0, part] = np.where(keys[at] == wanted, counts[at], 0)
            if len(short):
                cut = (wanted >> _CUT).view(np.int64)
                at = np.minimum(np.searchsorted(short, cut), len(short) - 1)
                held = values.reshape(4, -1)[:, at]
                found[1:, part] = np.where(short[at] == cut, held, 0)
        return found

    def score(self, texts: pa.Array) -> dict[str, np.ndarray]:
        before, tokens, offsets = token_hashes(texts)
        totals, cut = self._model.totals, self._pair_cut
        words, place = np.unique(np.concatenate([before, tokens]), return_inverse=True)
        values = self.word_values(words)
        left, right = place[: len(before)], place[len(before) :]
        counts, follows, one, two, more = values
        low = self._word_cut
        pairs = max(1, totals["pairs"])
        kept = low[1] * totals["w1"] + low[2] * totals["w2"] + low[3] * totals["w3up"]
        rest = kept / pairs if totals["pairs"] else 1.0
        lower = np.maximum(follows - low[np.minimum(follows, 3)], 0) / pairs
        lower = lower + rest / (totals["words"] + 1)
        seen = self.pair_counts(before >> _CUT, tokens >> _CUT)
        # A word is followed as often as it occurs; a text starts as often as it ends.
        of_word = np.where(words == START, values[0][np.searchsorted(words, END)], counts)
        of_left = of_word[left]
        left_over = (cut[1] * one + cut[2] * two + cut[3] * more)[left]
        known = (one + two + more)[left] > 0
        size = np.maximum(of_left, 1)
        upper = np.maximum(seen - cut[np.minimum(seen, 3)], 0) / size
        chance = np.where(known, upper + left_over / size * lower[right], lower[right])
        base = (counts + 0.5) / (totals["tokens"] + 0.5 * (totals["words"] + 1))
        rows = np.repeat(np.arange(len(texts)), np.diff(offsets))

        def summed(weights: np.ndarray) -> np.ndarray:
            return np.bincount(rows, weights=weights, minlength=len(texts))

        return {
            "n_tokens": np.diff(offsets),
            "n_known": summed((counts > 0)[right]).astype(np.int64),
            "base_score": summed(np.log10(base)[right]),
            "score": summed(np.log10(chance)),
        }


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs``: its tokens, the log10 probability of its text, and its perplexity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                found = scorer.score(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(column) for column in found.values()]],
                    names=["doc_id", *found],
                )

    ddl = "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"
    scored = filled(docs).mapInArrow(run, ddl)
    perplexity = F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
    return scored.withColumns(
        {
            "train_tokens": F.lit(model.totals["tokens"]).cast("bigint"),
            "perplexity": perplexity,
        }
    )


def held_out(fold: int = 1):
    return in_fold(F.col("doc_id"), fold)


def perplexities(docs: DataFrame) -> DataFrame:
    """Learns from the rows that are not held out, and scores all."""
    model = train(docs.where(~held_out()))
    return score(docs, model).withColumn("held_out", held_out())
