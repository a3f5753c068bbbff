"""Minimum bin slack: documents packed into windows of token ids with next to no padding.

A document is its ids and one end id. Whole windows are cut off its front; what remains, shorter
than a window, is a piece. How many pieces there are of each length is all that planning needs, and
there are fewer lengths than tokens in a window, so the plan is made from one small histogram:

* A bitset holds which sums the remaining lengths can reach (each with all its copies, the longest
  first). The reachable sum closest to the window is filled; tracing back through the bitsets tells
  how many copies of each length it takes. That choice is repeated as often as the counts allow, so
  a plan has a few thousand lines whatever the corpus. Lengths are never put back, which bounds it.
* Where the closest sum leaves slack, that many tokens come from a donor: pieces of the length with
  most tokens left, laid end to end and cut as needed. What no window takes is laid there as well,
  cut into windows, and the end into sequences of powers of two, which need no padding.

The pieces of a length are numbered over all tasks (a task numbers its own while it encodes, and
adds how many the tasks before it have), and their number says which line, window and place is
theirs: no group, sort or task holds all rows of a length, however many share one. Only documents
whose rest is cut are encoded again, to digest the parts.

Defined cases: a null or empty text is one end id; repeated rows are packed each; null ids are kept;
very long texts fill windows of their own; other columns are not read; ties between pieces of equal
length are broken by where they were read, so a rerun may swap documents of equal length; an empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulrate.llm.common import filled
from haulrate.llm.word_ids import ID_BYTES, read_tokenizer, word_codec
from haulrate.sources.shared import staged

CAPACITY = 2048
END_ID = 1
#: Texts encoded a second time are found by a broadcast up to so many pieces, else by a shuffle.
BROADCAST_PIECES = 100_000

_LENGTHS = (
    "part int, doc_id bigint, digest binary, n_tokens bigint, windows array<bigint>, "
    "windows_before bigint, rest int, rest_crc32 bigint, nth bigint"
)
_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("digest", pa.binary()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)
_PIECES_DDL = ", ".join(
    f"{field.name} {'binary' if field.name == 'digest' else 'bigint'}" for field in _PIECES
)


@dataclass(frozen=True)
class Plan:
    """Which pieces fill which sequences; a piece is (length, its number among that length).

    ``uses``, sorted: (length, first number, number after the last, copies in a window, first
    sequence, offset of the first copy). ``donors``, sorted: (length, first number, number after
    the last, token of the donor stream where they start). ``claims``, in the stream's order: (first
    token, tokens of each part, parts, first sequence, offset).
    """

    uses: np.ndarray
    donors: np.ndarray
    claims: np.ndarray
    sequences: int


def closest_window(counts: dict[int, int], capacity: int) -> tuple[int, dict[int, int]]:
    """The sum closest to the capacity that the lengths reach, and the copies of each it takes."""
    fits, full = (1 << (capacity + 1)) - 1, 1 << capacity
    reached, lengths = [1], []
    for length in sorted(counts, reverse=True):
        sums, copies, step = reached[-1], min(counts[length], capacity // length), 1
        while copies:
            some = min(step, copies)
            sums |= (sums << (length * some)) & fits
            copies -= some
            step *= 2
        lengths.append(length)
        reached.append(sums)
        if sums & full:
            break
    best = left = reached[-1].bit_length() - 1
    taken = {}
    for length, before in zip(reversed(lengths), reversed(reached[:-1])):
        copies = 0
        while not before >> (left - copies * length) & 1:
            copies += 1
        if copies:
            taken[length] = copies
            left -= copies * length
    return best, taken


def make_plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The plan for so many pieces of each length below ``capacity``."""
    left = {length: n for length, n in counts.items() if n and 0 < length < capacity}
    used = dict.fromkeys(left, 0)
    uses, donors, claims = [], [], []
    sequences = laid = claimed = 0  # laid and claimed: tokens of the donor stream

    def take(length: int, n: int) -> int:
        first = used[length]
        used[length] += n
        left[length] -= n
        if not left[length]:
            del left[length]
        return first

    def lay(length: int, n: int) -> None:
        nonlocal laid
        first = take(length, n)
        donors.append((length, first, first + n, laid))
        laid += length * n

    def claim(tokens: int, parts: int, offset: int) -> None:
        nonlocal claimed
        claims.append((claimed, tokens, parts, sequences, offset))
        claimed += tokens * parts

    total = sum(length * n for length, n in left.items())
    while total >= capacity:
        best, taken = closest_window(left, capacity)
        times, slack = min(left[length] // n for length, n in taken.items()), capacity - best
        if slack:
            donor = max(left, key=lambda length: (length * left[length], length))
            times = _most(times, left[donor], taken.get(donor, 0), donor, slack, laid - claimed)
            if not times:
                break
        offset = 0
        for length, n in sorted(taken.items(), reverse=True):
            first = take(length, n * times)
            uses.append((length, first, first + n * times, n, sequences, offset))
            offset += n * length
        if slack:
            if (need := times * slack - (laid - claimed)) > 0:
                lay(donor, -(-need // donor))
            claim(slack, times, best)
        sequences += times
        total -= times * capacity
    for length in sorted(left, reverse=True):
        lay(length, left[length])
    if (whole := (laid - claimed) // capacity) > 0:
        claim(capacity, whole, 0)
        sequences += whole
    rest = laid - claimed
    while rest:
        power = 1 << (rest.bit_length() - 1)
        claim(power, 1, 0)
        sequences += 1
        rest -= power

    def table(rows: list[tuple], width: int) -> np.ndarray:
        return np.array(sorted(rows), dtype=np.int64).reshape(-1, width)

    return Plan(table(uses, 6), table(donors, 4), table(claims, 5), sequences)


def _most(times: int, pieces: int, copies: int, donor: int, slack: int, spare: int) -> int:
    """The most windows, up to ``times``, of ``copies`` pieces of the donor and ``slack`` tokens
    each, which spare tokens and then further pieces of the donor have to give."""
    least = 0
    while least < times:
        middle = (least + times + 1) // 2
        cut = -(-max(0, middle * slack - spare) // donor)
        if middle * copies + cut <= pieces:
            least = middle
        else:
            times = middle - 1
    return times


def place(plan: Plan, length: int, number: int) -> list[tuple[int, int, int, int]]:
    """(start within the piece, length, sequence, offset) of the parts of a piece."""
    k = _line(plan.uses, length, number)
    if k is not None:
        _, first, _, copies, sequence, offset = plan.uses[k].tolist()
        window, copy = divmod(number - first, copies)
        return [(0, length, sequence + window, offset + copy * length)]
    k = _line(plan.donors, length, number)
    _, first, _, token = plan.donors[k].tolist()
    token += (number - first) * length
    parts, end, begin = [], token + length, token
    k = int(np.searchsorted(plan.claims[:, 0], token, side="right")) - 1
    while token < end:
        start, size, count, sequence, offset = plan.claims[k].tolist()
        part, within = divmod(token - start, size)
        if part >= count:
            k += 1
            continue
        stop = min(end, start + (part + 1) * size)
        parts.append((token - begin, stop - token, sequence + part, offset + within))
        token = stop
    return parts


def _line(lines: np.ndarray, length: int, number: int) -> int | None:
    """The line that holds the number of that length."""
    low, high = np.searchsorted(lines[:, 0], [length, length + 1])
    k = low + int(np.searchsorted(lines[low:high, 1], number, side="right")) - 1
    return k if k >= low and number < lines[k, 2] else None


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of each document, with its sequence and its place there."""
    read_tokenizer(tokenizer_path)
    texts = filled(docs).select("doc_id", "text", _digest().alias("digest"))
    lengths = staged(_lengths(texts, tokenizer_path, capacity), "lengths")
    counts = lengths.groupBy("rest").count().collect()  # at most ``capacity`` rows
    plan = make_plan({row["rest"]: row["count"] for row in counts}, capacity)

    before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = lengths.groupBy("rest", "part").agg(F.count("*").alias("pieces")).select(
        "rest", "part", F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("first")
    )
    numbered = lengths.join(starts, ["rest", "part"]).withColumn("nth", F.col("first") + F.col("nth"))
    pieces = staged(_pieces(numbered.select(*lengths.columns), plan, capacity), "pieces")
    whole = pieces.where(F.col("ids_crc32").isNotNull())
    cut = pieces.where(F.col("ids_crc32").isNull())
    if found := cut.count():
        whole = whole.unionByName(_digest_parts(cut, found, texts, tokenizer_path, capacity))
    return whole.drop("digest")


def _digest() -> F.Column:
    return F.unhex(F.sha2(F.col("text").cast("binary"), 256))


def _lengths(texts: DataFrame, tokenizer_path: str, capacity: int) -> DataFrame:
    """How long each document is, the digests of its windows and its rest, and the rest's number
    among those of its length that this task has read."""
    width, end = capacity * ID_BYTES, END_ID.to_bytes(ID_BYTES, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_codec(tokenizer_path)
        part = TaskContext.get().partitionId()
        seen, windows_seen = np.zeros(capacity, dtype=np.int64), 0
        for batch in batches:
            n_tokens, windows, before, rests, rest_crcs, nth = [], [], [], [], [], []
            for text in batch.column("text"):
                ids = encode(text.as_py()) + end
                cut = len(ids) // width * width
                rest = (len(ids) - cut) // ID_BYTES
                n_tokens.append(len(ids) // ID_BYTES)
                windows.append([zlib.crc32(ids[at : at + width]) for at in range(0, cut, width)])
                before.append(windows_seen)
                rests.append(rest)
                rest_crcs.append(zlib.crc32(ids[cut:]))
                nth.append(seen[rest])
                seen[rest] += 1
                windows_seen += cut // width
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * batch.num_rows, pa.int32()),
                    batch.column("doc_id"),
                    batch.column("digest"),
                    pa.array(n_tokens, pa.int64()),
                    pa.array(windows, pa.list_(pa.int64())),
                    pa.array(before, pa.int64()),
                    pa.array(rests, pa.int32()),
                    pa.array(rest_crcs, pa.int64()),
                    pa.array(nth, pa.int64()),
                ],
                names=[part.split()[0] for part in _LENGTHS.split(", ")],
            )

    return texts.mapInArrow(run, _LENGTHS)


def _pieces(numbered: DataFrame, plan: Plan, capacity: int) -> DataFrame:
    """The pieces; a part of a cut rest has no digest yet. Whole windows are sequences of their
    own, numbered beyond the plan's by the task that read them and their number there."""
    parts = (numbered.agg(F.max("part")).first()[0] or 0) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                key, tokens = (row["doc_id"], row["digest"]), row["n_tokens"]
                for k, crc in enumerate(row["windows"]):
                    sequence = plan.sequences + (row["windows_before"] + k) * parts + row["part"]
                    rows.append((*key, k * capacity, capacity, crc, tokens, sequence, 0))
                if not row["rest"]:
                    continue
                begin, placed = tokens - row["rest"], place(plan, row["rest"], row["nth"])
                crc = row["rest_crc32"] if len(placed) == 1 else None
                for start, length, sequence, offset in placed:
                    rows.append((*key, begin + start, length, crc, tokens, sequence, offset))
            columns = zip(*rows) if rows else [[]] * len(_PIECES)
            arrays = [pa.array(column, field.type) for column, field in zip(columns, _PIECES)]
            yield pa.RecordBatch.from_arrays(arrays, schema=_PIECES)

    return numbered.mapInArrow(run, _PIECES_DDL)


def _digest_parts(
    cut: DataFrame, found: int, texts: DataFrame, tokenizer_path: str, capacity: int
) -> DataFrame:
    """The digests of the parts of cut rests, from the ids of each distinct text that has one."""
    end = END_ID.to_bytes(ID_BYTES, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_codec(tokenizer_path)
        for batch in batches:
            rests = []
            for text in batch.column("text"):
                ids = encode(text.as_py()) + end
                rests.append(ids[len(ids) // (capacity * ID_BYTES) * capacity * ID_BYTES :])
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(rests, pa.binary())], names=["digest", "ids"]
            )

    wanted = cut.select("digest").distinct()
    small = found <= BROADCAST_PIECES
    again = texts.select("digest", "text").join(
        F.broadcast(wanted) if small else wanted, "digest", "left_semi"
    )
    rests = again.mapInArrow(run, "digest binary, ids binary")
    rests = rests.groupBy("digest").agg(F.max("ids").alias("ids"))
    within = (F.col("start") % capacity) * ID_BYTES + 1
    ids = F.substring("ids", within.cast("int"), (F.col("length") * ID_BYTES).cast("int"))
    return cut.join(rests, "digest").withColumn("ids_crc32", F.crc32(ids)).select(*cut.columns)
