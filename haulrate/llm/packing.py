"""Conflict-constrained best-fit packing of documents into bins of equal capacity.

Rows are dealt by a hash to packing groups of bounded size, and each group is packed on its own,
longest piece first. A group keeps its bins ordered by what room they have left. Every bin carries
two bitmaps: the sources that may not come again (they stand there ``per_source`` times) and the
duplicate clusters it holds. A piece goes to the tightest bin with room whose bitmaps leave its
bits free; the search goes from successor to successor until one is found, else a bin is opened.

A document is as long as its words, plus one end mark. What exceeds the capacity is cut: full
pieces have bins of their own, the last piece is packed like any other document.

Defined cases: a null or empty text is one end mark; null sources are one source; rows of equal
text (A-Z in lower case) are one duplicate cluster, so no bin holds two of them. Ties go to the
smaller id and the older bin, null ids last. Repeated rows are packed each; other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulrate.llm.exact_dedup import digest_of

CAPACITY = 4096
PER_SOURCE = 8
GROUP_ROWS = 4096
BIN_STRIDE = 1 << 32

PACKED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("part", pa.int64()),
        ("first_token", pa.int64()),
        ("n_tokens", pa.int64()),
        ("bin_id", pa.int64()),
        ("position", pa.int64()),
    ]
)
_DDL = ", ".join(f"{field.name} bigint" for field in PACKED)


class Bins:
    """Open bins by room, each with a bitmap of its full sources and one of its clusters."""

    def __init__(self, capacity: int, per_source: int):
        self._capacity, self._per_source = capacity, per_source
        self._by_room: list[tuple[int, int]] = []
        self._full: list[int] = []
        self._clusters: list[int] = []
        self._counts: list[dict[int, int]] = []
        self._filled: list[int] = []

    def open_bin(self) -> int:
        self._full.append(0)
        self._clusters.append(0)
        self._counts.append({})
        self._filled.append(0)
        return len(self._filled) - 1

    def put(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, position); ``cluster`` is a bitmap, empty for a text without copies."""
        bit = 1 << source
        by_room, full, clusters = self._by_room, self._full, self._clusters
        for at in range(bisect_left(by_room, (length, -1)), len(by_room)):
            room, k = by_room[at]
            if not full[k] & bit and not clusters[k] & cluster:
                del by_room[at]
                break
        else:
            room, k = self._capacity, self.open_bin()
        counts = self._counts[k]
        counts[source] = counts.get(source, 0) + 1
        if counts[source] >= self._per_source:
            full[k] |= bit
        clusters[k] |= cluster
        if room > length:
            insort(by_room, (room - length, k))
        position = self._filled[k]
        self._filled[k] += 1
        return k, position


def pack_rows(rows: list[tuple], capacity: int, per_source: int) -> list[tuple]:
    """(doc_id, part, first token, length, bin, position) of (doc_id, length, source, cluster)."""
    sources: dict[str, int] = {}
    seen: dict[bytes, int] = {}
    for _, _, source, cluster in rows:
        sources.setdefault(source, len(sources))
        seen[cluster] = seen.get(cluster, 0) + 1
    bits = {cluster: 1 << k for k, cluster in enumerate(c for c, n in seen.items() if n > 1)}
    bins, placed, last = Bins(capacity, per_source), [], []
    for doc_id, length, source, cluster in rows:
        full = (length - 1) // capacity
        for part in range(full):
            placed.append((doc_id, part, part * capacity, capacity, bins.open_bin(), 0))
        rest = length - full * capacity
        order = (-rest, doc_id is None, doc_id or 0, source or "", cluster)
        last.append((order, cluster, doc_id, full, source))
    for (negative, *_), cluster, doc_id, part, source in sorted(last, key=lambda x: x[0]):
        where = bins.put(-negative, sources[source], bits.get(cluster, 0))
        placed.append((doc_id, part, part * capacity, -negative, *where))
    return placed


def pack(
    docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE
) -> DataFrame:
    """One row per piece of each document, with its bin."""
    groups = max(1, math.ceil(docs.count() / GROUP_ROWS))
    text = F.coalesce("text", F.lit(""))
    lengths = docs.select(
        "doc_id",
        (F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")) + 1).cast("long").alias("length"),
        F.col("source").cast("string").alias("source"),
        digest_of(F.col("text")).alias("cluster"),
    )
    dealt = lengths.withColumn("group", F.pmod(F.xxhash64("doc_id", "cluster"), F.lit(groups)))

    def pack_group(rows: pa.Table) -> pa.Table:
        columns = [rows.column(c).to_pylist() for c in ("doc_id", "length", "source", "cluster")]
        packed = pack_rows(sorted(zip(*columns), key=_sort_key), capacity, per_source)
        group = rows.column("group")[0].as_py()
        out = [list(column) for column in zip(*packed)]
        out[4] = [group * BIN_STRIDE + k for k in out[4]]
        return pa.table(out, schema=PACKED)

    return dealt.groupBy("group").applyInArrow(pack_group, _DDL)


def _sort_key(row: tuple) -> tuple:
    doc_id, length, source, cluster = row
    return (doc_id is None, doc_id or 0, length, source or "", cluster)
