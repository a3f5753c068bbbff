"""Lookups: add columns from a card without ever changing the number of rows.

Each lookup adds one struct column holding the card's values; it is NULL on a miss, so the
caller decides whether a miss keeps the old value or computes over NULLs. When several card
rows match, the winner is fixed and the same for a card of any size: the lowest upper bound of
a band, then the lowest id, lower bound and values, NULLs first.

A card is broadcast only when its counted rows allow it. A larger one is joined by a shuffle,
of which adaptive execution splits the partitions that hot keys make too large.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulrate.functions import match_key
from haulrate.operators.segments import inside, segments
from haulrate.sources.cards import Card

ROW_ID = "packagematchid"
SALT = "__salt"
PARTS = 1 << 16
CELL = "__cell"


def row_hash(df: DataFrame) -> Column:
    """A value that differs between rows and is the same when a task is run again.

    Without a row id, equal rows of one partition share it.
    """
    if ROW_ID in df.columns:
        return F.xxhash64(ROW_ID)
    return F.xxhash64(F.spark_partition_id(), *df.columns)


def join_side(
    df: DataFrame,
    side: DataFrame,
    on: Mapping[str, Column],
    *,
    small: bool,
    how: str = "left",
) -> DataFrame:
    """Join a side that has one row per key: broadcast if small, else by a shuffle.

    ``on`` gives, for each key column of the side, the expression of ``df`` it must equal. Beyond
    the broadcast size adaptive execution measures the shuffled partitions and splits those of
    hot (or NULL) keys; it copies their part of the side only. ``df`` is read once.
    """
    equal = reduce(and_, [value == side[key] for key, value in on.items()])
    added = [side[name] for name in side.columns if name not in on]
    return df.join(F.broadcast(side) if small else side, equal, how).select(df["*"], *added)


def _comparable(card: DataFrame, name: str, value: Column) -> Column:
    return match_key(value) if isinstance(card.schema[name].dataType, T.StringType) else value


def _tie(card: DataFrame) -> list[str]:
    return ["id"] if "id" in card.columns else []


def one_per_key(
    card: DataFrame, keys: Sequence[str], value: Column, order: Column, name: str, small: bool
) -> DataFrame:
    """Reduce a card to the first row of each key by the given order.

    The reduction also tells Catalyst that keys are unique, so that it can drop the join where
    nothing of the card is read.
    """
    rows = card.select(*keys, value.alias(name), order.alias("__order")).dropna(subset=list(keys))
    if small:
        rows = rows.coalesce(1)  # already in one partition, so the reduction needs no shuffle
        return rows.groupBy(*keys).agg(F.min_by(name, "__order").alias(name))
    # Reduced in a partitioning of its own: only a side that the join itself shuffles can have
    # its partitions read several times, which splitting a hot key needs.
    part = F.pmod(F.xxhash64(*keys), F.lit(PARTS)).alias("__part")
    return rows.groupBy(*keys, part).agg(F.min_by(name, "__order").alias(name)).drop("__part")


@dataclass(frozen=True)
class Lookup:
    """One lookup of a card: a struct column ``name``, NULL on a miss.

    Either an expression over the working frame, or a side that is joined where ``meets`` holds,
    of which each row of the frame meets at most one. ``probe``: columns that ``meets`` compares,
    computed once per row before the join.
    """

    name: str
    value: Column | None = None
    side: DataFrame | None = None
    meets: Column | None = None
    small: bool = False
    probe: Mapping[str, Column] | None = None


def looked_up(
    df: DataFrame, lookups: Sequence[Lookup], columns: Mapping[str, Column] | None = None
) -> DataFrame:
    """The frame with columns computed from lookups, or with the lookups' own if none are given.

    However many lookups there are, they are joined one after the other and projected once, so that
    a frame is analysed once for each join and once for all columns.
    """
    joined = df
    for lookup in lookups:
        if lookup.side is not None:
            if lookup.probe:
                joined = joined.withColumns(lookup.probe)
            side = F.broadcast(lookup.side) if lookup.small else lookup.side
            joined = joined.join(side, lookup.meets, "left")
    values = {lookup.name: lookup.value for lookup in lookups if lookup.value is not None}
    if values:
        joined = joined.withColumns(values)
    if columns is None:
        return joined.select(*df.columns, *[lookup.name for lookup in lookups])
    kept = [name for name in df.columns if name not in columns]
    return joined.select(*kept, *[value.alias(name) for name, value in columns.items()])


def equi(
    card: Card, on: Sequence[tuple[str | Column, str]], take: Sequence[str], name: str
) -> Lookup:
    """The columns ``take`` of the card row whose keys are equal.

    ``on`` pairs a column or expression of the frame with a card column; texts are compared
    without case and trailing blanks.
    """
    keys = [f"__{name}{i}" for i in range(len(on))]
    own = {key: _comparable(card.df, col, F.col(col)) for key, (_, col) in zip(keys, on)}
    first, order = F.struct(*take), F.struct(*_tie(card.df), *take)
    if card.small:
        # One partition, so the reduction needs no shuffle; a NULL key's row equals nothing.
        named = [value.alias(key) for key, value in own.items()]
        side = card.df.coalesce(1).groupBy(*named).agg(F.min_by(first, order).alias(name))
    else:
        side = one_per_key(card.df.withColumns(own), keys, first, order, name, False)
    equal = [
        _comparable(card.df, col, F.col(value) if isinstance(value, str) else value) == side[key]
        for key, (value, col) in zip(keys, on)
    ]
    return Lookup(name, side=side, meets=reduce(and_, equal), small=card.small)


def equi_lookup(
    df: DataFrame,
    card: Card,
    on: Sequence[tuple[str | Column, str]],
    take: Sequence[str],
    name: str,
) -> DataFrame:
    """Add struct ``name`` of the card row whose keys are equal, as ``equi`` says."""
    return looked_up(df, [equi(card, on, take, name)])


def band(
    card: Card, value: str | Column, lo: str, hi: str, take: Sequence[str], name: str
) -> Lookup:
    """The columns ``take`` of the band lo <= value <= hi."""
    of = F.col(value) if isinstance(value, str) else value
    if card.literals is None:
        return _segment(card, of, lo, hi, take, name)
    types = {col: card.df.schema[col].dataType for col in take}
    bands = [row for row in card.literals if row[lo] is not None and row[hi] is not None]
    order = [hi, *_tie(card.df), lo, *take]
    bands.sort(key=lambda row: [rank(row[c]) for c in order])
    found = F.lit(None).cast(T.StructType([T.StructField(c, t) for c, t in types.items()]))
    for row in reversed(bands):
        values = F.expr(_struct_literal({c: (row[c], types[c]) for c in take}))
        found = F.when(of.between(row[lo], row[hi]), values).otherwise(found)
    return Lookup(name, value=found)


def _struct_literal(fields: Mapping[str, tuple[object, T.DataType]]) -> str:
    """A constant struct as one expression, parsed at once; texts are written as bytes, so that
    nothing in them has a meaning for the parser."""

    def literal(value: object, kind: str) -> str:
        if value is None:
            return f"cast(null AS {kind})"
        text = repr(value) if isinstance(value, float) else str(value)
        return f"cast(cast(X'{text.encode().hex()}' AS string) AS {kind})"

    parts = (f"'{c}', {literal(v, kind.simpleString())}" for c, (v, kind) in fields.items())
    return f"named_struct({', '.join(parts)})"


def band_lookup(
    df: DataFrame, card: Card, value: str, lo: str, hi: str, take: Sequence[str], name: str
) -> DataFrame:
    """Add struct ``name`` with the columns ``take`` of the band lo <= value <= hi."""
    return looked_up(df, [band(card, value, lo, hi, take, name)])


def rank(value) -> tuple:
    """A value's place in Spark's order: NULL before all values, NaN after them."""
    nan = isinstance(value, float) and math.isnan(value)
    return (value is not None, nan, 0 if value is None or nan else value)


def _segment(
    card: Card, value: Column, lo: str, hi: str, take: Sequence[str], name: str
) -> Lookup:
    """The same for a card of any size: its bands as disjoint segments, of which a value meets at
    most one, joined by the value's cell."""
    order = [hi, *_tie(card.df), lo, *take]
    found = card.prepared(
        ("segments", lo, hi, *take), lambda: segments(card.df, lo, hi, list(take), order)
    )
    if not found.count:
        nothing = card.df.select(F.struct(*take).alias("values")).schema["values"].dataType
        return Lookup(name, value=F.lit(None).cast(nothing))
    own = {c: name if c == "values" else f"__{name}_{c}" for c in found.rows.columns}
    rows = found.rows.select(*[F.col(c).alias(new) for c, new in own.items()])
    probe = f"__{name}_of"
    meets = (F.col(probe) == rows[own["cell"]]) & inside(
        value, *[rows[own[c]] for c in ("start", "start_open", "end", "end_open")]
    )
    small = found.count <= card.limits.broadcast_rows
    return Lookup(name, side=rows, meets=meets, small=small, probe={probe: found.cell(value)})


def pair_band_lookup(
    df: DataFrame,
    card: Card,
    on: Sequence[tuple[str, str]],
    value: str,
    hi: str,
    width: int,
    take: Sequence[str],
    name: str,
) -> DataFrame:
    """Add struct ``name`` of the card row with equal keys and hi - width <= value <= hi.

    The lowest upper bound wins, so of equal width each band keeps what lies above the bound
    before it: disjoint segments, as ``hi`` is a whole number none longer than ``width``, which
    touch at most two cells of that size.
    """
    keys = [f"__key{i}" for i in range(len(on))]
    named = card.df.withColumns(
        {key: _comparable(card.df, col, F.col(col)) for key, (_, col) in zip(keys, on)}
    ).withColumn("__hi", F.col(hi))
    bands = one_per_key(
        named,
        [*keys, "__hi"],
        F.struct(*take),
        F.struct(*_tie(card.df), *take),
        name,
        card.small,
    )
    # Only bounds within the width matter, so a key's bounds are looked at by their cells.
    cell = F.floor(F.col("__hi") / width)
    near = bands.select(*keys, (cell + 1).alias(CELL), F.col("__hi").alias("__below"))
    near = near.groupBy(*keys, CELL).agg(F.max("__below").alias("__below"))
    by_cell = Window.partitionBy(*keys, CELL).orderBy("__hi")
    bands = bands.withColumn(CELL, cell).join(near, [*keys, CELL], "left")
    bands = bands.withColumn("__below", F.coalesce(F.lag("__hi").over(by_cell), F.col("__below")))
    touched = F.sequence(F.floor((F.col("__hi") - width) / width), F.col(CELL))
    side = bands.withColumn(CELL, F.explode(touched))

    probe = {
        key: _comparable(card.df, col, F.col(left)) for key, (left, col) in zip(keys, on)
    }
    probe[CELL] = F.floor(F.col(value) / width)
    band = F.col(value).between(side["__hi"] - width, side["__hi"])
    only = band & (side["__below"].isNull() | (F.col(value) > side["__below"]))
    equal = reduce(and_, [of == side[key] for key, of in probe.items()])
    joined = df.join(F.broadcast(side) if card.small else side, equal & only, "left")
    return joined.select(df["*"], side[name])
