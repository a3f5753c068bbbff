"""What several operators need: tables, ASCII case, folds, bounded samples, texts in tasks."""

from __future__ import annotations

import string
import sys
from collections.abc import Callable, Iterator
from types import ModuleType
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

T_ = TypeVar("T_")
FOLDS = 5
ROWS_AT_ONCE = 256


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and texts; a null text counts as empty."""
    return filled(table(spark, sf_dir, "documents", "doc_id", "text"))


def filled(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {column.lower() for column in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def in_fold(doc_id: Column, fold: int) -> Column:
    """Whether crc32 of the id as text leaves that remainder by ``FOLDS``; false for null ids."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(remainder == fold, F.lit(False))


def bounded_sample(df: DataFrame, limit: int, *keys: str) -> DataFrame:
    """All rows if at most ``limit``, else about that many, chosen by a hash of the keys.

    Only to fit a classifier on: everything else has to read all rows.
    """
    rows = df.count()
    if rows <= limit:
        return df
    place = F.pmod(F.xxhash64(F.lit("sample"), *keys), F.lit(1 << 30))
    return df.where(place < int(limit / rows * (1 << 30)))


def once_per_process(key: tuple, make: Callable[[], T_]) -> T_:
    """What ``make`` gives, made once in a Python worker and kept for its later tasks.

    This package is sent to tasks by value, so it has no module of its own there to keep it in.
    """
    kept = sys.modules.setdefault("_haulrate_kept", ModuleType("_haulrate_kept")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def map_texts(
    docs: DataFrame,
    make: Callable[[], Callable[[list[str]], dict[str, list]]],
    schema: str,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The kept columns, and those that a function makes from each text of ``docs``.

    ``make`` is called once per task; the function it gives gets up to ``ROWS_AT_ONCE`` texts at
    a time, so a task holds one Arrow batch and the results of few texts.
    """
    kept = docs.select(*keep).schema
    fields = T.StructType.fromDDL(schema)
    arrow = pa.schema([(f.name, _arrow_type(f.dataType.simpleString())) for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                made = step(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(name) for name in keep]
                    + [pa.array(made[f.name], f.type) for f in arrow],
                    names=[*keep, *arrow.names],
                )

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return docs.mapInArrow(run, f"{columns}, {schema}")


def _arrow_type(name: str) -> pa.DataType:
    if name.startswith("array<"):
        return pa.list_(_arrow_type(name[6:-1]))
    return {
        "bigint": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "string": pa.string(),
        "boolean": pa.bool_(),
        "binary": pa.binary(),
    }[name]
