"""Document fingerprints by content-defined chunking.

A gear hash runs over the UTF-8 bytes of a text: each byte shifts the hash and adds a fixed random
number, so it depends on the last 32 bytes only. Chunks end where its top bits are zero; the bounds
are normalised, with more bits asked for below the normal size and fewer above it. Chunk ends move
with the text, so an insertion changes the chunks around it and no others. The fingerprint is the
sorted multiset of chunk digests with their lengths. What two fingerprints share, weighted by
length, over the longer one is their likeness, and over one of them how far that one is contained.

The successor of a row, by falling ``doc_id``, is found without one global sort: rows are dealt to
id ranges of even size, each range also gets the first row of the next one, and a task walks its
sorted range once. The texts are shuffled once.

Defined cases: a null text is empty; empty fingerprints are alike (1) to each other and unlike (0)
to all others. Null ids come last; rows of one id are ordered by a hash of their texts. A single
row is its own successor. Texts are read whole, other columns are not read, and an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulrate.llm.common import filled

LEAST, NORMAL, MOST = 32, 64, 256
STRICT_BITS, LOOSE_BITS = 8, 4
WINDOW = 32
DIGEST_BYTES = 8
RANGE_ROWS = 4096
MOST_RANGES = 20_000
BLOCK_CHARS = 1 << 20
NO_ID = -(1 << 63)

_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
        ("contained_in_next", pa.float64()),
    ]
)
_DDL = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, contained_in_next double"
)


def gear_table() -> np.ndarray:
    """256 numbers from a fixed rule (splitmix)."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(32)).astype(np.uint32)


def gear_hashes(data: np.ndarray, gear: np.ndarray) -> np.ndarray:
    """The gear hash after every byte, by doubling the span that each entry sums up."""
    hashes = gear[data]
    span = 1
    while span < WINDOW:
        longer = hashes.copy()
        longer[span:] += hashes[:-span] << np.uint32(span)
        hashes, span = longer, span * 2
    return hashes


def chunk_ends(start: int, stop: int, strict: list[int], loose: list[int]) -> list[int]:
    """Ends of the chunks of bytes ``start`` to ``stop``; the lists hold possible ends."""
    ends = []
    while stop - start > LEAST:
        low, normal, most = start + LEAST, min(start + NORMAL, stop), min(start + MOST, stop)
        at = bisect_left(strict, low)
        end = strict[at] if at < len(strict) else stop
        if end >= normal:
            at = bisect_left(loose, normal)
            end = min(loose[at] if at < len(loose) else stop, most)
        ends.append(end)
        start = end
    if stop > start:
        ends.append(stop)
    return ends


def chunk_counts(texts: list[str], gear: np.ndarray) -> list[dict[tuple[str, int], int]]:
    """For each text, how often each (digest, length) occurs among its chunks."""
    encoded = [text.encode("utf-8", "surrogatepass") for text in texts]
    data = b"".join(encoded)
    hashes = gear_hashes(np.frombuffer(data, dtype=np.uint8), gear) if data else gear[:0]
    loose_at = np.flatnonzero(hashes >> np.uint32(32 - LOOSE_BITS) == 0)
    strict_at = loose_at[hashes[loose_at] >> np.uint32(32 - STRICT_BITS) == 0]
    ends = np.cumsum([0] + [len(e) for e in encoded])
    loose_cut, strict_cut = np.searchsorted(loose_at, ends), np.searchsorted(strict_at, ends)
    found, digest = [], hashlib.blake2b
    for k, text in enumerate(encoded):
        loose = (loose_at[loose_cut[k] : loose_cut[k + 1]] - (ends[k] - 1)).tolist()
        strict = (strict_at[strict_cut[k] : strict_cut[k + 1]] - (ends[k] - 1)).tolist()
        counts: dict[tuple[str, int], int] = {}
        start = 0
        for end in chunk_ends(0, len(text), strict, loose):
            chunk = digest(text[start:end], digest_size=DIGEST_BYTES).hexdigest(), end - start
            counts[chunk] = counts.get(chunk, 0) + 1
            start = end
        found.append(counts)
    return found


def written(counts: dict[tuple[str, int], int]) -> str:
    """Sorted ``digest:length`` entries, with ``*n`` for what occurs n times."""
    return ",".join(
        f"{digest}:{length}" if n == 1 else f"{digest}:{length}*{n}"
        for (digest, length), n in sorted(counts.items())
    )


def size_of(counts: dict[tuple[str, int], int]) -> int:
    return sum(length * n for (_, length), n in counts.items())


def shared(a: dict, b: dict) -> int:
    """Bytes of the chunks that both have."""
    if len(b) < len(a):
        a, b = b, a
    return sum(chunk[1] * min(n, b[chunk]) for chunk, n in a.items() if chunk in b)


def likeness(a: dict, b: dict) -> float:
    longer = max(size_of(a), size_of(b))
    return shared(a, b) / longer if longer else 1.0


def containment(a: dict, b: dict) -> float:
    """How far ``a`` is contained in ``b``."""
    size = size_of(a)
    return shared(a, b) / size if size else float(not b)


def edited_text(text: str, following: str) -> str:
    """The last third of the text replaced by as much of the start of another one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _ranges(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest key of each id range, rising."""
    count = docs.count()
    ranges = min(MOST_RANGES, max(1, count // RANGE_ROWS))
    keys = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("key"))
    found = (
        keys.repartitionByRange(ranges, "key")
        .groupBy(F.spark_partition_id().alias("range"))
        .agg(F.min("key").alias("low"), F.max("key").alias("high"))
        .collect()
    )
    found = sorted((row["low"], row["high"]) for row in found)
    return np.array([x for x, _ in found], "int64"), np.array([x for _, x in found], "int64")


def _in_ranges(docs: DataFrame, low: np.ndarray, high: np.ndarray) -> DataFrame:
    """Rows with their range; a range's first row is also the last of the range before it."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            home = np.searchsorted(low, keys, side="right") - 1
            rows = np.flatnonzero(keys == high[home])
            where = np.concatenate([home, (home[rows] + 1) % len(low)])
            guests = np.concatenate([np.zeros(len(keys), bool), np.ones(len(rows), bool)])
            taken = batch.take(pa.array(np.concatenate([np.arange(len(keys)), rows])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(where.astype(np.int32)), pa.array(guests), *taken.columns],
                names=["range", "guest", *taken.schema.names],
            )

    keyed = docs.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("key"),
        F.xxhash64("text").alias("tie"),
        "doc_id",
        "text",
    )
    ddl = "range int, guest boolean, key bigint, tie bigint, doc_id bigint, text string"
    return (
        keyed.mapInArrow(deal, ddl)
        .repartitionById(len(low), F.col("range"))
        .sortWithinPartitions("range", "guest", F.desc("key"), "tie")
    )


def fingerprint(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: fingerprints of the text and of the edited text, likenesses."""
    docs = filled(docs)
    low, high = _ranges(docs)
    if not len(low):
        return docs.sparkSession.createDataFrame([], _DDL)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gear = gear_table()
        held: list[tuple] = []
        chars = 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                names = ("range", "guest", "doc_id", "text")
                for row in zip(*[part.column(name).to_pylist() for name in names]):
                    held.append(row)
                    chars += len(row[3])
                    if chars > BLOCK_CHARS and len(held) > 1:
                        yield _block(held, gear)
                        held, chars = held[-1:], len(row[3])
        if len(held) > 1:
            yield _block(held, gear)

    return _in_ranges(docs, low, high).mapInArrow(walk, _DDL)


def _block(rows: list[tuple], gear: np.ndarray) -> pa.RecordBatch:
    """Results of the rows that are followed by one; guests are followed by nothing."""
    texts = [row[3] for row in rows]
    pairs = [
        k for k in range(len(rows) - 1) if not rows[k][1] and rows[k][0] == rows[k + 1][0]
    ]
    edits = [edited_text(texts[k], texts[k + 1]) for k in pairs]
    own, edited = chunk_counts(texts, gear), chunk_counts(edits, gear)
    out = [
        (
            rows[k][2],
            len(texts[k]),
            hashlib.sha256(edit.encode("utf-8", "surrogatepass")).hexdigest(),
            written(own[k]),
            written(other),
            likeness(own[k], other),
            likeness(own[k], own[k + 1]),
            containment(own[k], own[k + 1]),
        )
        for k, edit, other in zip(pairs, edits, edited)
    ]
    columns = list(zip(*out)) or [[] for _ in _SCHEMA]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(columns, _SCHEMA)], schema=_SCHEMA
    )
