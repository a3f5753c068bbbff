"""Hard negatives of embedding rows by a secondary sort.

Every row whose id is divisible by ``ANCHOR_EVERY`` is an anchor. Rows and anchors are packed into
blocks of vectors and dealt to a grid of cells: a group of anchor blocks beside a slice of the row
blocks. The task of a cell holds its anchors, streams one row block after the other past them, and
scores all their pairs with matrix products, exactly, in integers. No two blocks are joined in a row.
A pair is packed into a byte key (anchor, descending score, negative or positive, id) whose byte
order is that order; ``repartitionAndSortWithinPartitions`` deals the keys by anchor and sorts them
in the shuffle, so a task streams through the pairs of one anchor after the other and holds a few
windows, never an anchor's pairs.

It takes two such passes. The first finds the positives, the anchor's best rows of its own label; a
cell sends no more of them than an anchor can use. The second knows their scores, so a cell sends
only the best rows of other labels that fall into a positive's window, as many as are asked for. In
the merged stream a positive opens its window and negatives are emitted to the windows they fall in,
until each has its number. What a cell holds back is behind as many better ones of the same cell, so
nothing is lost, and the shuffle grows with anchors times slices, not with pairs. There are more
groups only where anchors are more than a task should hold, and at most ``ANCHOR_EVERY`` slices a
group, so that the copies of the anchors weigh no more than those of the rows.

Defined cases: rows with a null id, label or vector, an empty vector, or any null or non-finite
component take no part. Vectors of different lengths do not meet. Of rows that share an id one takes
part, the least by label, then vector. Labels and components are changed as ``prepared`` says. Equal
scores go to the smaller id. An anchor without positives or negatives gives no rows; an empty table
gives an empty result; other columns are not read. Products beyond what doubles hold exactly are
computed in Python's integers; a score beyond 64 bits that is computed is an error.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulrate.sources.shared import staged

ANCHOR_EVERY = 50
RELABEL_EVERY = 7
LABELS = 10
SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: A negative's score is between these hundredths of the positive's.
LOW, HIGH = 50, 95
#: Rows and anchors of a block; a task holds the scores of one row block with one anchor block.
ROWS_IN_BLOCK = 4096
ANCHORS_IN_BLOCK = 1024
#: Numbers of a block, which long vectors reach before its rows.
NUMBERS_IN_BLOCK = 1 << 20
BLOCKS_IN_FILE = 8
#: Anchors that a task holds at once, and their numbers.
ANCHORS_HELD = 1 << 17
NUMBERS_HELD = 1 << 24
#: Multiples of it fall evenly between whole numbers, however many there are.
GOLDEN = (math.sqrt(5) - 1) / 2
#: Below these, sums of whole numbers are exact in singles and in doubles.
EXACT_SINGLE, EXACT = float(1 << 24), float(1 << 53)

_KEY = ">QQBQ"
ANCHOR_BYTES = 8
_SIGN = 1 << 63
_POSITIVE, _NEGATIVE = 0, 1

_BLOCKS = (
    "dim bigint, size bigint, anchors bigint, task bigint, nth bigint, kind string, "
    "ids binary, labels binary, vectors binary, scores array<array<bigint>>"
)
_DEALT = f"{_BLOCKS}, cell int"
_ROWS = "id bigint, label bigint, vector array<double>"
_SCORES = pa.list_(pa.list_(pa.int64()))
_PAIRS = "key binary"
_FOUND = "anchor_id bigint, positive_id bigint, positive_score bigint"
_RESULT = (
    "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
    "positive_score bigint, negative_score bigint"
)


def pack_key(anchor: int, score: int, kind: int, row: int) -> bytes:
    """A key whose order as bytes is (anchor, descending score, positive first, id)."""
    return struct.pack(_KEY, anchor + _SIGN, _SIGN - 1 - score, kind, row + _SIGN)


def pack_keys(anchors: np.ndarray, scores: np.ndarray, kind: int, rows: np.ndarray) -> pa.Array:
    """``pack_key`` of many pairs, whose numbers are 64-bit integers."""
    fields = [("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("row", ">u8")]
    keys = np.empty(len(rows), fields)
    sign = np.uint64(_SIGN)
    keys["anchor"], keys["row"] = anchors.view("u8") ^ sign, rows.view("u8") ^ sign
    keys["score"], keys["kind"] = ~(scores.view("u8") ^ sign), kind
    ends = np.arange(len(rows) + 1, dtype="i4") * keys.itemsize
    return pa.Array.from_buffers(
        pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(keys.tobytes())]
    )


def unpack_key(key: bytes) -> tuple[int, int, int, int]:
    anchor, score, kind, row = struct.unpack(_KEY, key)
    return anchor - _SIGN, _SIGN - 1 - score, kind, row - _SIGN


def prepared(rows: DataFrame) -> DataFrame:
    """The rows that take part, one per id, with changed labels."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    moved = F.when(
        F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label").cast("long") + 1) % LABELS
    ).otherwise(F.col("label").cast("long"))
    takes_part = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite
    row = F.struct(moved.alias("label"), vector.alias("vector")).alias("row")
    kept = rows.where(takes_part & (F.size("embedding") > 0)).select(
        F.col("vec_id").cast("long").alias("id"), row
    )
    return kept.groupBy("id").agg(F.min("row").alias("row")).select("id", "row.label", "row.vector")


def _blocks(
    rows: DataFrame, most: int, scale: int = 1, groups: int = 0, slices: int = 0
) -> DataFrame:
    """The rows packed into blocks of at most ``most`` vectors of one length, by ascending id,
    components floored to whole numbers after scaling; with their positives' scores if these are
    known. With ``slices`` a block of anchors comes once for every slice of its group, with its
    cell: one by one, as a row that is exploded would be held in all its copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        task, nth = TaskContext.get().partitionId(), 0

        def packed(dim: int) -> Iterator[pa.RecordBatch]:
            nonlocal nth
            ids, labels, vectors, scores = zip(*sorted(held.pop(dim), key=lambda row: row[0]))
            whole = np.floor(np.concatenate(vectors) * scale)
            largest = np.abs(whole).max()
            kind = "<i2" if largest < 1 << 15 else "<i4" if largest < 1 << 31 else "<f8"
            sides = (np.array(ids, "<i8"), np.array(labels, "<i8"), whole.astype(kind))
            known = None if scores[0] is None else scores
            anchors = sum(key % ANCHOR_EVERY == 0 for key in ids)
            numbers = [pa.array([x], pa.int64()) for x in (dim, len(ids), anchors, task, nth)]
            columns = [pa.array([side.tobytes()], pa.binary()) for side in sides]
            columns = [*numbers, pa.array([kind]), *columns, pa.array([known], _SCORES)]
            names = ["dim", "size", "anchors", "task", "nth", "kind"]
            names += ["ids", "labels", "vectors", "scores"]
            if not slices:
                yield pa.RecordBatch.from_arrays(columns, names=names)
            group = (int(task * GOLDEN % 1 * groups) + nth) % max(1, groups)
            for k in range(slices):
                cell = pa.array([group * slices + k], pa.int32())
                yield pa.RecordBatch.from_arrays([*columns, cell], names=[*names, "cell"])
            nth += 1

        for batch in batches:
            ids, labels = batch.column("id").to_pylist(), batch.column("label").to_pylist()
            vectors, scores = batch.column("vector"), [None] * batch.num_rows
            if "scores" in batch.schema.names:
                scores = batch.column("scores").to_pylist()
            ends, values = vectors.offsets.to_numpy(), vectors.values.to_numpy()
            for k, key in enumerate(ids):
                vector = values[ends[k] : ends[k + 1]]
                dim = len(vector)
                block = held.setdefault(dim, [])
                block.append((key, labels[k], vector, scores[k]))
                if len(block) == most or len(block) * dim >= NUMBERS_IN_BLOCK:
                    yield from packed(dim)
        for dim in list(held):
            yield from packed(dim)

    return rows.mapInArrow(run, _DEALT if slices else _BLOCKS)


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number vectors, a line per anchor, as whole numbers in the
    least type that holds their sums exactly."""
    largest = (np.abs(side).max(initial=0) for side in (anchors, rows))
    most = math.prod(map(float, largest)) * anchors.shape[1]
    if most < EXACT:
        kind = "f4" if most < EXACT_SINGLE else "f8"
        return anchors.astype(kind) @ rows.astype(kind).T
    exact = [[int(x) for x in line] for line in anchors], [[int(x) for x in line] for line in rows]
    table = [[sum(map(int.__mul__, a, b)) for b in exact[1]] for a in exact[0]]
    return np.array(table, dtype=np.int64).reshape(len(anchors), len(rows))


def _nth(slots: np.ndarray) -> np.ndarray:
    """Of ascending numbers, how many equal ones stand before each."""
    return np.arange(len(slots)) - np.searchsorted(slots, slots)


def _places(among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines and columns of what is true; several times faster than ``nonzero`` of two axes."""
    return np.divmod(np.flatnonzero(among), among.shape[1])


def _thinned(scores: np.ndarray, among: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines and columns of ``among``; of lines with many at least the best ``most``: highest
    score, then first column. What is left does not grow with the columns."""
    lines, at = _places(among)
    if len(lines) <= 8 * most * len(scores):
        return lines, at
    lowest = -np.inf if scores.dtype.kind == "f" else np.iinfo(scores.dtype).min
    least = np.partition(np.where(among, scores, lowest), -most, axis=1)[:, -most]
    lines, at = _places(among & (scores >= least[:, None]))
    ties = np.flatnonzero(scores[lines, at] == least[lines])
    kept = np.ones(len(lines), bool)
    kept[ties[_nth(lines[ties]) >= most]] = False
    return lines[kept], at[kept]


class _Best:
    """The best ``most`` pairs of each slot so far: highest score, then smaller id."""

    def __init__(self, slots: int, most: int):
        self.most = most
        self.slots = self.scores = self.ids = np.empty(0, np.int64)
        #: What a pair has to score to be among them.
        self.least = np.full(slots, np.iinfo(np.int64).min)

    def add(self, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        if not sum(len(slots) for slots, _, _ in found):
            return
        sides = zip((self.slots, self.scores, self.ids), *found)
        slots, scores, ids = (np.concatenate(side) for side in sides)
        order = np.lexsort((ids, ~scores, slots))
        nth = _nth(slots[order])
        order, nth = order[nth < self.most], nth[nth < self.most]
        self.slots, self.scores, self.ids = slots[order], scores[order], ids[order]
        full = nth == self.most - 1
        self.least[self.slots[full]] = self.scores[full]


class _Rows:
    """A block of rows, by ascending id."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.labels = np.frombuffer(row["labels"], "<i8")
        self.vectors = np.frombuffer(row["vectors"], row["kind"]).reshape(-1, row["dim"])

    def by_label(self) -> dict[int, np.ndarray]:
        """The places of each label's rows, ascending."""
        order = np.argsort(self.labels, kind="stable")
        labels, starts = np.unique(self.labels[order], return_index=True)
        return dict(zip(labels.tolist(), np.split(order, starts[1:])))


class _Positives(_Rows):
    """A block of anchors, and the best rows of their labels among the blocks met."""

    def __init__(self, row: dict, most: int):
        super().__init__(row)
        self.of_label = self.by_label()
        self.best = _Best(len(self.ids), most)

    def meet(self, rows: _Rows, by_label: dict[int, np.ndarray]) -> None:
        found = []
        for label in self.of_label.keys() & by_label.keys():
            mine, theirs = self.of_label[label], by_label[label]
            ids = rows.ids[theirs]
            scores = products(self.vectors[mine], rows.vectors[theirs])
            among = scores >= self.best.least[mine].astype(scores.dtype)[:, None]
            own = np.minimum(np.searchsorted(ids, self.ids[mine]), len(ids) - 1)
            among[np.arange(len(mine)), own] &= ids[own] != self.ids[mine]
            lines, at = _thinned(scores, among, self.best.most)
            found.append((mine[lines], scores[lines, at].astype(np.int64), ids[at]))
        self.best.add(found)

    def keys(self) -> pa.Array:
        return pack_keys(self.ids[self.best.slots], self.best.scores, _POSITIVE, self.best.ids)


class _Negatives(_Rows):
    """A block of anchors with known positives, and the best rows of other labels in the window of
    each positive among the blocks met. A slot is an anchor and one of its windows."""

    def __init__(self, row: dict, most: int):
        super().__init__(row)
        windows = max(map(len, row["scores"]))
        bounds = np.iinfo(np.int64)
        self.low = np.full((len(self.ids), windows), bounds.max)
        self.high = np.full((len(self.ids), windows), bounds.min)
        for k, known in enumerate(row["scores"]):
            for j, score in enumerate(known):
                low, high = -(-LOW * score // 100), HIGH * score // 100
                if low <= high:
                    self.low[k, j], self.high[k, j] = low, high
        self.best = _Best(self.low.size, most)

    def meet(self, rows: _Rows, by_label: dict[int, np.ndarray]) -> None:
        scores = products(self.vectors, rows.vectors)
        least = np.maximum(self.low, self.best.least.reshape(self.low.shape))
        windows, found = least.shape[1], []

        def fitting(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            low, high = low.astype(scores.dtype)[:, None], high.astype(scores.dtype)[:, None]
            return (scores >= low) & (scores <= high)

        among = fitting(least.min(axis=1), self.high.max(axis=1))
        if np.count_nonzero(among) > 8 * self.best.most * len(self.ids):
            other = rows.labels != self.labels[:, None]
            for j in range(windows):
                fits = fitting(least[:, j], self.high[:, j]) & other
                lines, at = _thinned(scores, fits, self.best.most)
                of = scores[lines, at].astype(np.int64)
                found.append((lines * windows + j, of, rows.ids[at]))
        else:
            lines, at = _places(among)
            other = rows.labels[at] != self.labels[lines]
            lines, at = lines[other], at[other]
            of = scores[lines, at].astype(np.int64)
            for j in range(windows):
                fits = (of >= least[lines, j]) & (of <= self.high[lines, j])
                found.append((lines[fits] * windows + j, of[fits], rows.ids[at[fits]]))
        self.best.add(found)

    def keys(self) -> pa.Array:
        """A row that is in several windows of an anchor has one key."""
        lines, scores, ids = self.best.slots // self.low.shape[1], self.best.scores, self.best.ids
        order = np.lexsort((ids, lines))
        lines, scores, ids = lines[order], scores[order], ids[order]
        new = np.ones(len(ids), bool)
        new[1:] = (lines[1:] != lines[:-1]) | (ids[1:] != ids[:-1])
        return pack_keys(self.ids[lines[new]], scores[new], _NEGATIVE, ids[new])


def _anchors(blocks: DataFrame) -> DataFrame:
    """The anchors of the row blocks, one by one, their components whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rows = _Rows(batch.slice(k, 1).to_pylist()[0])
                at = np.flatnonzero(rows.ids % ANCHOR_EVERY == 0)
                vectors = rows.vectors[at].astype("f8")
                ends = np.arange(len(at) + 1, dtype="i4") * vectors.shape[1]
                vectors = pa.ListArray.from_arrays(pa.array(ends), pa.array(vectors.ravel()))
                columns = [pa.array(rows.ids[at]), pa.array(rows.labels[at]), vectors]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "vector"])

    return blocks.select("dim", "kind", "ids", "labels", "vectors").mapInArrow(run, _ROWS)


def _grid(blocks: DataFrame, parts: int, anchors_held: int) -> tuple[int, int, int]:
    """The number of anchors, of groups of them, and of slices of the row blocks."""
    totals = blocks.agg(
        F.count("*").alias("blocks"),
        F.sum("anchors").alias("anchors"),
        F.sum(F.col("anchors") * F.col("dim")).alias("numbers"),
        F.sum(F.col("size") * F.col("dim")).alias("row_numbers"),
    ).first()
    anchors = totals["anchors"] or 0
    held = max(anchors / anchors_held, (totals["numbers"] or 0) / NUMBERS_HELD)
    groups = max(1, math.ceil(held))
    slices = min(parts // groups, ANCHOR_EVERY * groups)
    slices = max(slices, (totals["row_numbers"] or 0) // NUMBERS_HELD, 1)
    return anchors, groups, max(1, min(slices, totals["blocks"]))


def _dealt(blocks: DataFrame, anchors: DataFrame, groups: int, slices: int) -> DataFrame:
    """The blocks of each cell in one partition, by vector length, anchors before rows.

    The blocks of a task go to slices in turn, beginning at a place of the task's own.
    """
    begin = F.floor(F.pmod(F.col("task") * GOLDEN, F.lit(1.0)) * slices)
    group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    cell = F.col("group") * slices + F.pmod(begin + F.col("nth"), F.lit(slices))
    rows = blocks.withColumn("group", group).withColumn("cell", cell.cast("int")).drop("group")
    both = anchors.withColumn("row", F.lit(False)).unionByName(rows.withColumn("row", F.lit(True)))
    return both.repartitionById(groups * slices, "cell").sortWithinPartitions("dim", "row")


def _pairs(dealt: DataFrame, best: type[_Positives] | type[_Negatives], most: int) -> DataFrame:
    """The packed keys of the pairs that a cell may contribute to each of its anchors.

    For positives these are the best rows of the anchor's label; for negatives, the best rows of
    other labels in each known positive's window.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        dim = None

        def found(of: Iterable) -> Iterator[pa.RecordBatch]:
            for anchors in of:
                yield pa.RecordBatch.from_arrays([anchors.keys()], names=["key"])

        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if row["dim"] != dim:
                    yield from found(held)
                    held, dim = [], row["dim"]
                if not row["row"]:
                    held.append(best(row, most))
                elif held:
                    rows = _Rows(row)
                    by_label = rows.by_label()
                    for anchors in held:
                        anchors.meet(rows, by_label)
        yield from found(held)

    return dealt.mapInArrow(run, _PAIRS)


def _sorted_by_anchor(pairs: DataFrame, partitions: int):
    """The keys as an RDD, dealt by anchor and sorted within each partition by the shuffle."""
    keyed = pairs.rdd.map(lambda row: (bytes(row[0]), None))
    return keyed.repartitionAndSortWithinPartitions(
        partitions, lambda key: zlib.crc32(key[:ANCHOR_BYTES])
    ).keys()


def first_positives(keys: Iterator[bytes], most: int = POSITIVES) -> Iterator[tuple]:
    """(anchor, positive, score) of the first ``most`` pairs of each anchor in a sorted stream."""
    current, count = None, 0
    for key in keys:
        anchor, score, _, row = unpack_key(key)
        if anchor != current:
            current, count = anchor, 0
        if count < most:
            count += 1
            yield anchor, row, score


def windows(keys: Iterator[bytes], most: int = NEGATIVES) -> Iterator[tuple]:
    """The result rows of a sorted stream: positives open windows, negatives fall into them."""
    current, opened = None, []
    for key in keys:
        anchor, score, kind, row = unpack_key(key)
        if anchor != current:
            current, opened = anchor, []
        if kind == _POSITIVE:
            opened.append([row, score, 0])
            continue
        for window in opened:
            positive, of, rank = window
            if rank < most and LOW * of <= 100 * score <= HIGH * of:
                window[2] = rank + 1
                yield anchor, positive, rank + 1, row, of, score


def mine(
    rows: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    rows_in_block: int = ROWS_IN_BLOCK,
    anchors_in_block: int = ANCHORS_IN_BLOCK,
    anchors_held: int = ANCHORS_HELD,
) -> DataFrame:
    """For each anchor and positive its first hard negatives, with their scores."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = _blocks(prepared(rows), rows_in_block, SCALE)
    blocks = staged(blocks, "row-blocks", BLOCKS_IN_FILE)
    count, groups, slices = _grid(blocks, parts, anchors_held)
    anchors = _anchors(blocks)
    many = max(1, math.ceil(count / anchors_in_block))

    def dealt(of: DataFrame) -> DataFrame:
        packed = _blocks(of.repartition(many, "id"), anchors_in_block, 1, groups, slices)
        return _dealt(blocks, packed, groups, slices)

    keys = _sorted_by_anchor(_pairs(dealt(anchors), _Positives, positives), parts)
    found = keys.mapPartitions(lambda part: first_positives(part, positives))
    first = staged(spark.createDataFrame(found, _FOUND, verifySchema=False), "positives")

    # Anchors without a positive have no window, so they take no part in the second pass.
    scores = first.groupBy(F.col("anchor_id").alias("id")).agg(
        F.collect_list("positive_score").alias("scores")  # at most ``positives`` of them
    )
    pairs = _pairs(dealt(anchors.join(scores, "id")), _Negatives, negatives)
    opening = first.rdd.map(lambda r: (pack_key(r[0], r[2], _POSITIVE, r[1]),))
    pairs = pairs.unionByName(spark.createDataFrame(opening, _PAIRS, verifySchema=False))
    keys = _sorted_by_anchor(pairs, parts)
    mined = keys.mapPartitions(lambda part: windows(part, negatives))
    return spark.createDataFrame(mined, _RESULT, verifySchema=False)
