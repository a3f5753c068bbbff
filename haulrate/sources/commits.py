"""Commit records in a folder: loads that add nothing twice, and tables that are never half there.

A record is one small file that appears whole under its final name, by a rename that never replaces
another: of several runs that commit the same name exactly one succeeds. Data are written first, to
a path of their own; a record that names the path makes them part of the table. So a job that is
lost before its record has changed nothing, and what it left is never read.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulrate.sources.shared import file_system, hadoop_path


class CommitLog:
    """Named records in a folder that Hadoop's file systems reach, each written once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._files = file_system(spark, self.folder)

    def commit(self, name: str, record: dict) -> bool:
        """Whether this call wrote the record; False if one of that name was there before."""
        draft = self._path(f".{uuid.uuid4().hex}")
        out = self._files.create(draft, False)
        try:
            out.write(bytearray(json.dumps(record).encode()))
        finally:
            out.close()
        final = self._path(f"{name}.json")
        done = not self._files.exists(final) and self._files.rename(draft, final)
        if not done:
            self._files.delete(draft, False)
        return done

    def records(self) -> dict[str, dict]:
        """All records by name, in the order of the names."""
        if not self._files.exists(hadoop_path(self.spark, self.folder)):
            return {}
        listed = self._files.listStatus(hadoop_path(self.spark, self.folder))
        names = sorted(status.getPath().getName() for status in listed)
        found = [name for name in names if name.endswith(".json") and not name.startswith(".")]
        return {name.removesuffix(".json"): json.loads(self._text(name)) for name in found}

    def _text(self, name: str) -> str:
        stream = self._files.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _path(self, name: str):
        return hadoop_path(self.spark, f"{self.folder}/{name}")


@dataclass(frozen=True)
class Window:
    """Source rows with ``after`` < date <= ``until``."""

    after: date
    until: date

    @property
    def batch(self) -> str:
        return f"{self.after.isoformat()}_{self.until.isoformat()}"

    def holds(self, day: Column) -> Column:
        return (day > F.lit(self.after)) & (day <= F.lit(self.until))


class LedgerTable:
    """A table of appended batches, of which a ledger says what is in it.

    A batch is a window of the source's dates. One that is committed is not loaded again, and of
    one that overlaps committed windows only the days that none of them holds are added; so any
    load may run again, at any time and after any failure. Runs at the same time have to load the
    same windows or disjoint ones.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.ledger = CommitLog(spark, f"{self.folder}/_ledger")

    def append(self, rows: DataFrame, day: str, window: Window) -> bool:
        """Adds the window's rows; False if its batch was there, or another run was first."""
        known = self.ledger.records()
        if window.batch in known:
            return False
        told = [Window(*map(date.fromisoformat, (r["after"], r["until"]))) for r in known.values()]
        new = window.holds(F.col(day).cast("date"))
        for earlier in told:
            if earlier.after < window.until and window.after < earlier.until:
                new = new & ~earlier.holds(F.col(day).cast("date"))
        path = f"batches/{window.batch}-{uuid.uuid4().hex}"
        rows.where(new).write.parquet(f"{self.folder}/{path}")
        record = {
            "path": path,
            "after": window.after.isoformat(),
            "until": window.until.isoformat(),
            "schema": rows.schema.json(),
        }
        return self.ledger.commit(window.batch, record)

    def read(self) -> DataFrame:
        """The committed batches, and nothing else that lies in the folder."""
        records = self.ledger.records()
        if not records:
            raise FileNotFoundError(f"no batch is committed in {self.folder}")
        frames = []
        for record in records.values():
            schema = T.StructType.fromJson(json.loads(record["schema"]))
            frame = self.spark.read.schema(schema).parquet(f"{self.folder}/{record['path']}")
            frames.append(frame)
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


class VersionedTable:
    """A table whose refreshes are complete before anyone reads them.

    Every refresh is a new version in a folder of its own; a numbered pointer makes it the current
    one. Readers take the highest pointer's version and keep it while they run: a refresh never
    changes files that are read, and one that fails leaves no pointer.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.pointers = CommitLog(spark, f"{self.folder}/_current")

    def version(self) -> int:
        """The number of the current version, 0 before the first."""
        return max(map(int, self.pointers.records()), default=0)

    def refresh(self, rows: DataFrame) -> int:
        """Publishes the rows as the next version and returns its number.

        A refresh that another one overtook is published after it, as the later one to end.
        """
        path = f"versions/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.folder}/{path}")
        record = {"path": path, "schema": rows.schema.json()}
        number = self.version() + 1
        while not self.pointers.commit(f"{number:010d}", record):
            number += 1
        return number

    def read(self, version: int | None = None) -> DataFrame:
        """The current version, or an earlier one that has not been retired."""
        records = self.pointers.records()
        name = f"{version or max(map(int, records), default=0):010d}"
        if name not in records:
            raise FileNotFoundError(f"version {version} of {self.folder} is not published")
        schema = T.StructType.fromJson(json.loads(records[name]["schema"]))
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{records[name]['path']}")

    def retire(self, keep: int = 2) -> int:
        """Removes the files of all but the last versions, and returns how many it removed.

        Readers of an older version fail, so keep as many as refreshes that a reader outlives.
        """
        files, removed = file_system(self.spark, self.folder), 0
        records = self.pointers.records()
        kept = {records[name]["path"] for name in sorted(records)[-keep:]}
        for record in records.values():
            path = hadoop_path(self.spark, f"{self.folder}/{record['path']}")
            if record["path"] not in kept and files.exists(path):
                removed += files.delete(path, True)
        return removed
