"""Overlapping bands as disjoint segments, each with the one band that wins there.

The distinct bounds of all bands, sorted, are cut into cells of a fixed number of bounds each; a value
finds its cell by a binary search in the cells' first bounds, which the plan holds as one constant. A
band has a part in the cell of its lower bound and one in the cell of its upper bound, and covers the
cells between wholly. Of equal parts the first band stays, so that a bound of many bands, such as an
open end, leaves one part per bound it meets. Of the bands that cover a cell wholly only the first
counts: they go to the few nodes of a binary tree over the cells, each node keeps its first band, and a
cell asks the nodes above it.

As the lowest upper bound wins, a cell is swept from its end to its start with a stack: a part that
begins, seen from the end, hides all others until its lower bound. The parts pass by in sorted order,
so a task holds no more than the stack of one cell. What is left are disjoint segments, cut where a
cell ends: a value meets one at most, however many bands overlap there and however many are open, and
joins by equality with the few segments of one cell.

No step holds all bands or bounds: they are sorted and numbered by range.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulrate.sources.shared import staged

#: Bounds of a cell, and how many cells there are at most; a larger card has larger cells.
CELL_BOUNDS = 32
MOST_CELLS = 131_072
#: Levels of the tree that a cell asks at once; the levels above are asked for blocks of cells.
TIER = 5
#: ``monotonically_increasing_id`` holds the number within a partition in so many bits.
LOCAL_BITS = 33


@dataclass(frozen=True)
class Segments:
    """Disjoint segments (``cell``, ``start``, ``end``, whether these are open, ``values``); one
    without start or end goes on to that of its cell."""

    rows: DataFrame
    count: int
    splits: list[str]
    bound_type: T.DataType

    def cell(self, value: Column) -> Column:
        """The cell that a value belongs to: how many cells begin at or below it, less one."""
        return _cell(value, self.splits, self.bound_type)


def _cell(value: Column, splits: list[str], bound_type: T.DataType) -> Column:
    # One constant of the plan: texts of numbers and times have no comma.
    firsts = F.split(F.lit(",".join(splits)), ",").cast(f"array<{bound_type.simpleString()}>")
    steps = [1 << k for k in reversed(range(len(splits).bit_length()))]

    def step(at: Column, by: Column) -> Column:
        return F.when(F.get(firsts, at + by - 1) <= value, at + by).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step) - 1


def inside(value: Column, start: Column, start_open: Column, end: Column, end_open: Column) -> Column:
    """Whether the value lies in the segment."""
    after = F.when(start_open, value > start).otherwise(value >= start)
    before = F.when(end_open, value < end).otherwise(value <= end)
    return (start.isNull() | after) & (end.isNull() | before)


def _numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """The rows, written once, with numbers that grow in the given order (and may have gaps)."""
    return staged(rows.orderBy(*order).withColumn(name, F.monotonically_increasing_id()), name)


def _ranked(bounds: DataFrame) -> DataFrame:
    """The bounds with their ranks: what the partitions before hold, a row for each, is added."""
    parted = bounds.select(
        "bound",
        F.shiftrightunsigned("number", LOCAL_BITS).alias("part"),
        F.col("number").bitwiseAND((1 << LOCAL_BITS) - 1).alias("place"),
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = parted.groupBy("part").count()
    offsets = sizes.select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    return parted.join(F.broadcast(offsets), "part").select(
        "bound", (F.col("first") + F.col("place")).alias("rank")
    )


def _tree(bands: DataFrame, levels: int) -> DataFrame:
    """The first band of each node: a band goes to the largest nodes that it covers wholly."""
    # No node of a level that holds more cells than the band covers can lie within it.
    deepest = F.least(F.ceil(F.log2(F.col("last") - F.col("first") + 2)).cast("int"), F.lit(levels))
    every = F.explode(F.sequence(F.lit(0), deepest)).alias("level")
    at = bands.select("band", "first", "last", every)
    at = at.select(
        "band",
        "level",
        F.expr("shiftright(first + shiftleft(1L, level) - 1, level)").alias("low"),
        F.expr("shiftright(last + 1, level)").alias("high"),
    ).where("low < high")
    left = F.when(F.col("low") % 2 == 1, F.col("low"))
    right = F.when(F.col("high") % 2 == 1, F.col("high") - 1)
    nodes = at.select("band", "level", F.explode(F.array_compact(F.array(left, right))).alias("node"))
    return nodes.groupBy("level", "node").agg(F.min("band").alias("band"))


def _winners(tree: DataFrame, cells: int, levels: int) -> DataFrame:
    """The first band that covers each cell wholly, asked tier by tier from the top of the tree."""
    spark, above = tree.sparkSession, None
    for base in reversed(range(0, levels + 1, TIER)):
        ids = spark.range((cells - 1 >> base) + 1)
        asked = ids.select("id", F.explode(F.sequence(F.lit(0), F.lit(TIER - 1))).alias("up"))
        asked = asked.select(
            "id", (F.col("up") + base).alias("level"), F.expr("shiftright(id, up)").alias("node")
        )
        found = asked.join(tree, ["level", "node"]).select("id", "band")
        if above is not None:
            parents = ids.withColumn("parent", F.shiftright("id", TIER))
            inherited = parents.join(above.withColumnRenamed("id", "parent"), "parent")
            found = found.unionByName(inherited.select("id", "band"))
        above = found.groupBy("id").agg(F.min("band").alias("band"))
    return above.select(F.col("id").cast("int").alias("cell"), "band")


def _parts(spans: DataFrame) -> DataFrame:
    """What each band (``band``, ``lo``, ``hi`` and their cells ``first``, ``last``) has in the cells,
    of equal parts the first band's; no bound where it goes on. ``until``: the last of the cells
    from ``cell`` on that are covered wholly."""
    kind = spans.schema["lo"].dataType
    # NaN, above all numbers, begins a cell of its own, which such a bound covers.
    bound = (lambda b: F.nanvl(b, F.lit(None).cast(kind))) if _floating(kind) else (lambda b: b)
    lo, hi, first, last = bound(F.col("lo")), bound(F.col("hi")), F.col("first"), F.col("last")
    which = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("which")
    at = spans.select("*", which).where(F.col("which") <= last - first)
    lower, upper = F.col("which") == 0, F.col("which") == 1
    at = at.select(
        F.when(lower, first).when(upper, last).otherwise(first + 1).alias("cell"),
        F.when(F.col("which") == 2, last - 1).alias("until"),
        F.when(lower, lo).alias("lo"),
        F.when(upper | lower & (first == last), hi).alias("hi"),
        "band",
    )
    return at.groupBy("cell", "until", "lo", "hi").agg(F.min("band").alias("band"))


def _floating(kind: T.DataType) -> bool:
    return isinstance(kind, T.FloatType | T.DoubleType)


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The segments of parts that come by cell, the last band first, so by falling upper bounds.

    The stack holds bands whose lower bounds fall towards its bottom; ``end`` is up to where all
    is decided.
    """
    cell, stack, end, end_open, out = None, [], None, False, []
    schema = None

    def made() -> pa.RecordBatch:
        kinds = [schema.field(c).type for c in ("cell", "lo", "lo", "band")]
        kinds[2:2] = [pa.bool_()]
        kinds[4:4] = [pa.bool_()]
        names = ["cell", "start", "start_open", "end", "end_open", "band"]
        columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    for batch in batches:
        schema = batch.schema
        for at, lo, hi, band in zip(*[batch.column(c).to_pylist() for c in ("cell", "lo", "hi", "band")]):
            if at != cell:
                while stack:
                    start, top = stack.pop()
                    out.append((cell, start, False, end, end_open, top))
                    end, end_open = start, True
                cell, end, end_open = at, None, False
            if hi is not None:
                while stack:
                    start, top = stack[-1]
                    if start is None or start <= hi:
                        if end is None or end > hi:
                            out.append((cell, hi, True, end, end_open, top))
                        break
                    out.append((cell, start, False, end, end_open, top))
                    end, end_open = start, True
                    stack.pop()
                end, end_open = hi, False
            while stack and (lo is None or stack[-1][0] is not None and stack[-1][0] >= lo):
                stack.pop()
            stack.append((lo, band))
        if out:
            yield made()
            out = []
    while stack:
        start, top = stack.pop()
        out.append((cell, start, False, end, end_open, top))
        end, end_open = start, True
    if out:
        yield made()


def segments(card: DataFrame, lo: str, hi: str, take: list[str], order: list[str]) -> Segments:
    """The segments of the bands lo <= value <= hi, of which the first by ``order`` wins, whose own
    first column is ``hi``."""
    rows = card.where(F.col(lo) <= F.col(hi))
    values = F.struct(*take).alias("values")
    ordered = [F.col(c).alias(f"order{k}") for k, c in enumerate(order)]
    both = [F.col(lo).alias("lo"), F.col(hi).alias("hi"), values]
    sort = [f"order{k}" for k in range(len(order))]
    bands = _numbered(rows.select(*ordered, *both), sort, "band").drop(*sort)
    bounds = bands.select(F.col("lo").alias("bound")).union(bands.select("hi")).distinct()
    numbered = _numbered(bounds, ["bound"], "number")
    ranked, count = _ranked(numbered), numbered.count()
    kind = numbered.schema["bound"].dataType

    per_cell = max(CELL_BOUNDS, -(-count // MOST_CELLS))
    begins = F.col("rank") % per_cell == 0
    if _floating(kind):
        begins |= F.isnan("bound")
    firsts = ranked.where(begins).orderBy("rank")
    splits = [row[0] for row in firsts.select(F.col("bound").cast("string")).collect()]

    spans = bands.select("band", *[F.col(c).cast(kind).alias(c) for c in ("lo", "hi")])
    cells = [_cell(F.col(c), splits, kind).alias(at) for c, at in (("lo", "first"), ("hi", "last"))]
    parts = staged(_parts(spans.select("*", *cells)), "band-parts")
    whole = F.col("until").isNotNull()
    covers = parts.where(whole).select("band", F.col("cell").cast("long").alias("first"), F.col("until").cast("long").alias("last"))
    levels = len(splits).bit_length()
    tree = staged(_tree(covers, levels), "band-tree")
    won = _winners(tree, max(1, len(splits)), levels)

    none = F.lit(None).cast(kind)
    met = parts.where(~whole).select("cell", "lo", "hi", "band")
    met = met.unionByName(won.select("cell", none.alias("lo"), none.alias("hi"), "band"))
    met = met.repartition("cell").sortWithinPartitions("cell", F.desc("band"))
    bound = kind.simpleString()
    swept = met.mapInArrow(
        _sweep,
        f"cell int, start {bound}, start_open boolean, end {bound}, end_open boolean, band bigint",
    )
    found = swept.join(bands.select("band", "values"), "band")
    kept = staged(found.select("cell", "start", "end", "start_open", "end_open", "values"), "segments")
    return Segments(kept, kept.count(), splits, kind)
