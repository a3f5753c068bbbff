"""Exact dedup against a minimal perfect hash over the distinct digests of a history.

The history's distinct digests are dealt to shards of bounded size. Each shard becomes one row: a
minimal perfect hash (levels of bits; a digest belongs to the first level where nothing else has
its place, and its slot is the rank of that bit), and slots with the full digest and the locator of
the row that stays. A lookup finds one slot and compares all 32 bytes: equal is a repeat, unequal
no member, so a digest that the hash never saw cannot be taken for another.

Rows are reduced to one per distinct digest before they meet a shard, so a text that a third of
all rows share is one lookup. The digests that no slot holds are grouped on their own.

Defined cases: a null text is empty; empty texts are equal to each other. The row with the largest
``doc_id`` stays, null ids count as smallest; of rows that also share the id exactly one stays.
Other columns of ``docs`` are neither read nor changed. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulrate.llm.common import fresh, lower_ascii
from haulrate.sources.shared import staged

SHARD_DIGESTS = 8192
BITS_PER_DIGEST = 2.0
WIDTH = 32
#: The copies to drop are broadcast if counted and at most so many, of 40 bytes each.
BROADCAST_COPIES = 200_000

INDEX = (
    "shard bigint, level_bits array<bigint>, bits binary, digests binary, "
    "keep_ids array<bigint>, keep_rows array<bigint>, sizes array<bigint>"
)
GROUPS = "digest binary, keep_id bigint, keep_row bigint, group_size bigint, seen boolean"
_GROUPS = pa.schema(
    [
        ("digest", pa.binary()),
        ("keep_id", pa.int64()),
        ("keep_row", pa.int64()),
        ("group_size", pa.int64()),
        ("seen", pa.bool_()),
    ]
)


def digest_of(text) -> F.Column:
    """SHA-256 of the text with A-Z in lower case."""
    return F.unhex(F.sha2(lower_ascii(F.coalesce(text, F.lit(""))).cast("binary"), 256))


def digested(docs: DataFrame) -> DataFrame:
    """``doc_id``, a row number that tells equal rows apart, and the digest, written once."""
    return staged(
        docs.select(
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            digest_of(F.col("text")).alias("digest"),
        ),
        "digests",
    )


def shards_for(rows: int) -> int:
    return max(1, math.ceil(rows / SHARD_DIGESTS))


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """One row per shard of the history's distinct digests."""
    return (
        _distinct(history, shards).groupBy("shard").applyInArrow(_build_shard, INDEX)
    )


def group_by_index(index: DataFrame, rows: DataFrame, shards: int) -> DataFrame:
    """Every distinct digest of the index and of ``rows`` with its size and the row that stays."""
    left, right = index.groupBy("shard"), _distinct(rows, shards).groupBy("shard")
    return left.cogroup(right).applyInArrow(_merge_shard, GROUPS)


def duplicate_groups(rows: DataFrame) -> DataFrame:
    """Groups of ``digested`` rows: the lower half of the ids is the history, the rest meets it."""
    low, high, count = rows.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    shards = shards_for(count)
    in_history = F.coalesce(F.col("doc_id") <= ((low or 0) + (high or 0)) // 2, F.lit(True))
    index = staged(build_index(rows.where(in_history), shards), "digest-index")
    return group_by_index(index, rows.where(~in_history), shards)


def dedup_rows(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``, dropped ones too, with the row of its group that stays."""
    rows = digested(docs)
    groups = duplicate_groups(rows)
    return rows.join(groups, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        F.col("seen").alias("in_history"),
    )


def keep_first_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text a kept row has, all columns as they are.

    The few rows that go are found among digests alone, so texts are shuffled only if there are
    too many of them to broadcast, and then once. Rows that share text and id with the one that
    stays are reduced to one apart from all others.
    """
    rows = digested(docs)
    groups = duplicate_groups(rows).where("group_size > 1").select("digest", "keep_id")
    copies = rows.join(groups, "digest").groupBy("digest", "doc_id", "keep_id")
    copies = staged(copies.agg(F.count("*").alias("n")), "copies")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    digest = fresh(docs, "_digest")
    marked = docs.withColumn(digest, digest_of(F.col("text")))

    def among(found: DataFrame, count: int, how: str) -> DataFrame:
        found = found.select(
            F.col("digest").alias(f"{digest}_copy"), F.col("doc_id").alias(f"{digest}_id")
        )
        same = (F.col(digest) == F.col(f"{digest}_copy")) & F.col("doc_id").eqNullSafe(
            F.col(f"{digest}_id")
        )
        return marked.join(F.broadcast(found) if count <= BROADCAST_COPIES else found, same, how)

    twins = copies.where(stays & (F.col("n") > 1))
    gone, several = copies.where(~stays).count(), twins.count()
    if not several:
        return among(copies.where(~stays), gone, "left_anti").drop(digest)
    apart = copies.where(~stays).unionByName(twins)
    ones = among(twins, several, "left_semi").dropDuplicates(["doc_id", digest])
    return among(apart, gone + several, "left_anti").unionByName(ones).drop(digest)


def _distinct(rows: DataFrame, shards: int) -> DataFrame:
    """One row per digest; the partial aggregate leaves one per task of however many copies."""
    best = F.max(F.struct("doc_id", "row"))
    return (
        rows.groupBy("digest")
        .agg(best.alias("best"), F.count("*").alias("n"))
        .select(
            F.pmod(F.xxhash64("digest"), F.lit(shards)).alias("shard"),
            "digest",
            F.col("best.doc_id").alias("keep_id"),
            F.col("best.row").alias("keep_row"),
            "n",
        )
    )


def _matrix(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype=np.uint64).reshape(len(digests), WIDTH // 8)


def _mix(words: np.ndarray) -> np.ndarray:
    words = (words ^ (words >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    words = (words ^ (words >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return words ^ (words >> np.uint64(31))


def _places(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """The place of each digest among ``size`` bits; every level deals them anew."""
    mixed = np.full(len(words), 0x9E3779B97F4A7C15 * (level + 1) & (2**64 - 1), dtype=np.uint64)
    for k in range(words.shape[1]):
        mixed = _mix(mixed ^ words[:, k])
    return (mixed % np.uint64(size)).astype(np.int64)


def perfect_hash(words: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Bits of each level, and the slot (0 to n-1) of each of n distinct digests."""
    levels, slots, left, taken = [], np.empty(len(words), dtype=np.int64), np.arange(len(words)), 0
    while len(left):
        size = max(8, math.ceil(len(left) * BITS_PER_DIGEST))
        at = _places(words[left], len(levels), size)
        bits = np.bincount(at, minlength=size) == 1
        rank = np.cumsum(bits) - 1 + taken
        alone = bits[at]
        slots[left[alone]] = rank[at[alone]]
        levels.append(bits)
        taken += int(bits.sum())
        left = left[~alone]
    return levels, slots


def find_slots(levels: list[np.ndarray], words: np.ndarray) -> np.ndarray:
    """The only slot where each digest can be; -1 where every level says no."""
    slots, left, taken = np.full(len(words), -1, dtype=np.int64), np.arange(len(words)), 0
    for level, bits in enumerate(levels):
        at = _places(words[left], level, len(bits))
        hit = bits[at]
        slots[left[hit]] = (np.cumsum(bits) - 1 + taken)[at[hit]]
        taken += int(bits.sum())
        left = left[~hit]
    return slots


def _build_shard(rows: pa.Table) -> pa.Table:
    digests = rows.column("digest").to_pylist()
    levels, slots = perfect_hash(_matrix(digests))
    order = np.argsort(slots)
    by_slot = rows.take(pa.array(order))
    shard = {
        "shard": rows.column("shard")[:1],
        "level_bits": [[len(bits) for bits in levels]],
        "bits": [np.packbits(np.concatenate(levels)).tobytes()],
        "digests": [b"".join(by_slot.column("digest").to_pylist())],
        "keep_ids": [by_slot.column("keep_id").to_pylist()],
        "keep_rows": [by_slot.column("keep_row").to_pylist()],
        "sizes": [by_slot.column("n").to_pylist()],
    }
    types = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary()] + 3 * [
        pa.list_(pa.int64())
    ]
    return pa.table(shard, schema=pa.schema(list(zip(shard, types))))


def _levels(sizes: list[int], packed: bytes) -> list[np.ndarray]:
    bits = np.unpackbits(np.frombuffer(packed, dtype=np.uint8), count=sum(sizes)).astype(bool)
    return np.split(bits, np.cumsum(sizes)[:-1])


def _merge_shard(index: pa.Table, rows: pa.Table) -> pa.Table:
    """A shard's slots with what the rows add to them, then the digests that no slot holds."""
    fresh = [[], [], [], [], []]
    if not index.num_rows:
        merged = [[], [], [], [], []]
        members = set()
        incoming = rows.to_pylist()
    else:
        (shard,) = index.to_pylist()
        slots_of = shard["digests"]
        held = [slots_of[k : k + WIDTH] for k in range(0, len(slots_of), WIDTH)]
        merged = [held, shard["keep_ids"], shard["keep_rows"], shard["sizes"], [True] * len(held)]
        incoming = rows.to_pylist()
        members = set()
        if incoming:
            levels = _levels(shard["level_bits"], shard["bits"])
            found = find_slots(levels, _matrix([row["digest"] for row in incoming]))
            for k, (row, slot) in enumerate(zip(incoming, found.tolist())):
                if slot < 0 or held[slot] != row["digest"]:
                    continue
                members.add(k)
                merged[3][slot] += row["n"]
                mine = _order(row["keep_id"], row["keep_row"])
                if mine > _order(merged[1][slot], merged[2][slot]):
                    merged[1][slot], merged[2][slot] = row["keep_id"], row["keep_row"]
    for k, row in enumerate(incoming):
        if k not in members:
            for column, value in zip(
                fresh, (row["digest"], row["keep_id"], row["keep_row"], row["n"], False)
            ):
                column.append(value)
    return pa.table([a + b for a, b in zip(merged, fresh)], schema=_GROUPS)


def _order(doc_id: int | None, row: int) -> tuple:
    return (doc_id is not None, doc_id or 0, row)
