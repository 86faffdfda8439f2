"""Stored tables that change by whole versions: a version is a list of files that never change.

A write puts new files beside the old ones and then renames a new list into place, which either
happens or doesn't: a failed write leaves the version before as it was, and a reader keeps the
files of the version it began with. A merge or a reload rewrites only the files that hold rows
it touches and takes the others over. What Spark keeps on the driver for a scan, the names of
its files, is all that is kept here.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from datetime import date
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from sabermill.operators.merge import merge

FILES, VERSIONS = "files", "versions"


class Pointer:
    """Numbered JSON records under a folder; the last one counts, and none is ever replaced."""

    def __init__(self, spark: SparkSession, folder: str):
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.folder = folder
        path = self.hadoop.Path(folder)
        self.files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        self.context = self.hadoop.FileContext.getFileContext(
            path.toUri() if path.isUriPathAbsolute() and path.toUri().getScheme() else self.files.getUri(),
            spark._jsc.hadoopConfiguration(),
        )
        self.none = spark.sparkContext._gateway.new_array(self.hadoop.Options.Rename, 0)

    def number(self) -> int:
        """Of the last record; 0 if there is none."""
        folder = self.hadoop.Path(self.folder)
        if not self.files.exists(folder):
            return 0
        names = [s.getPath().getName() for s in self.files.listStatus(folder)]
        return max((int(n) for n in names if n.isdigit()), default=0)

    def read(self, number: int) -> dict:
        stream = self.files.open(self.hadoop.Path(f"{self.folder}/{number:012d}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def commit(self, number: int, record: dict) -> None:
        """Make ``record`` the one with this number; an error if another writer has just done so."""
        aside = self.hadoop.Path(f"{self.folder}/_{uuid.uuid4().hex}")
        stream = self.files.create(aside, False)
        try:
            stream.write(json.dumps(record).encode())
        finally:
            stream.close()
        place = self.hadoop.Path(f"{self.folder}/{number:012d}")
        self.context.rename(self.files.makeQualified(aside), self.files.makeQualified(place), self.none)


class VersionedTable:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.pointer = Pointer(spark, f"{self.folder}/{VERSIONS}")

    @classmethod
    def create(cls, folder: str, df: DataFrame, cluster_by: Iterable[str] = ()) -> VersionedTable:
        table = cls(df.sparkSession, folder)
        table._commit(0, {"schema": df.schema.jsonValue(), "cluster_by": [*cluster_by], "files": [], "done": []}, [], df)
        return table

    def state(self) -> tuple[int, dict]:
        number = self.pointer.number()
        if not number:
            raise FileNotFoundError(f"no table at {self.folder}")
        return number, self.pointer.read(number)

    def _frame(self, state: dict, files: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(state["schema"])
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/{FILES}/{f}" for f in files])

    def read(self, version: int | None = None) -> DataFrame:
        """The last version, or an earlier one."""
        state = self.state()[1] if version is None else self.pointer.read(version)
        return self._frame(state, state["files"])

    def _commit(self, number: int, state: dict, replaced: list[str], rows: DataFrame | None, done: str | None = None) -> None:
        """The next version: the files before without ``replaced``, and ``rows`` in files of their own."""
        files = [f for f in state["files"] if f not in set(replaced)]
        if rows is not None:
            own = uuid.uuid4().hex
            if state["cluster_by"]:
                # Neighbouring keys share files, so that a later batch of few keys touches few files.
                rows = rows.repartitionByRange(*state["cluster_by"]).sortWithinPartitions(*state["cluster_by"])
            rows.write.parquet(f"{self.folder}/{FILES}/{own}")
            schema = T.StructType.fromJson(state["schema"])
            written = self.spark.read.schema(schema).parquet(f"{self.folder}/{FILES}/{own}")
            files += [self._name(f) for f in written.inputFiles()]
        record = state | {"files": files, "done": [*state["done"], *([done] if done else [])]}
        self.pointer.commit(number + 1, record)

    @staticmethod
    def _name(path: str) -> str:
        return "/".join(unquote(path).split("/")[-2:])

    def _holding(self, state: dict, found: Callable[[DataFrame], DataFrame]) -> list[str]:
        """Files with a row that ``found`` keeps."""
        if not state["files"]:
            return []
        rows = self._frame(state, state["files"])
        rows = found(rows.select("*", F.col("_metadata.file_path").alias("_file")))
        return [self._name(r["_file"]) for r in rows.select("_file").distinct().collect()]

    def append(self, rows: DataFrame, load: str | None = None) -> bool:
        """Add rows; False, and nothing done, if a load of this name has been stored."""
        number, state = self.state()
        if load in state["done"]:
            return False
        self._commit(number, state, [], rows, load)
        return True

    def merge(
        self, batch: DataFrame, keys: list[str], order: str, update_columns: list[str] | None = None,
        defaults: dict | None = None, load: str | None = None, order_is_row: bool = False,
    ) -> bool:
        """A keyed merge that rewrites only the files that hold a key of the batch.

        Rows of the batch with a key that no file holds go to new files. Where nothing is to be
        updated no file is rewritten at all. A load of a name that is stored already does nothing.
        """
        number, state = self.state()
        if load is not None and load in state["done"]:
            return False
        full = reduce(and_, [F.col(k).isNotNull() for k in keys])
        asked = batch.where(full).select(*keys)
        if update_columns == []:
            known = self._frame(state, state["files"]).select(*keys)
            batch, touched = batch.join(known, keys, "left_anti"), []
        else:
            touched = self._holding(state, lambda rows: rows.join(asked, keys, "left_semi"))
        merged = merge(self._frame(state, touched), batch, keys, order, update_columns, defaults, order_is_row)
        self._commit(number, state, touched, merged, load)
        return True

    def replace(self, where: Column, rows: DataFrame, load: str | None = None) -> None:
        """Put ``rows`` in place of those that meet a condition; files without such rows stay as they are."""
        number, state = self.state()
        touched = self._holding(state, lambda stored: stored.where(where))
        rest = self._frame(state, touched).where(~F.coalesce(where, F.lit(False)))
        self._commit(number, state, touched, rest.unionByName(rows) if touched else rows, load)


def load_chunks(
    table: VersionedTable, chunks: Iterable[tuple[date, date]], fetch: Callable[[date, date], DataFrame], day: str,
    again: bool = False,
) -> dict[tuple[date, date], str]:
    """Load a range chunk by chunk; a chunk that fails is skipped, and the next run goes on with it.

    A chunk's rows take the place of those its days held before, in one commit with the note that it is
    loaded, so a chunk that is loaded ``again`` or was cut off counts once. Returns what became of
    each chunk: "loaded", "kept" (loaded earlier) or the error.
    """
    outcome = {}
    for start, end in chunks:
        name = f"{day}:{start}:{end}"
        if not again and name in table.state()[1]["done"]:
            outcome[start, end] = "kept"
            continue
        try:
            inside = F.col(day).between(F.lit(start), F.lit(end))
            table.replace(inside, fetch(start, end).where(inside), name)
            outcome[start, end] = "loaded"
        except Exception as error:  # noqa: BLE001  any source may fail in its own way
            outcome[start, end] = f"{type(error).__name__}: {str(error)[:200]}"
    return outcome


def export_version(tables: dict[str, DataFrame], folder: str) -> int:
    """Write all tables as one version: readers see all of them or those of the version before."""
    spark = next(iter(tables.values())).sparkSession
    pointer = Pointer(spark, f"{folder}/{VERSIONS}")
    number, paths = pointer.number() + 1, {}
    for name, df in tables.items():
        paths[name] = f"{FILES}/{uuid.uuid4().hex}/{name}"
        df.write.parquet(f"{folder}/{paths[name]}")
    pointer.commit(number, {name: {"path": path, "schema": tables[name].schema.jsonValue()} for name, path in paths.items()})
    return number


def read_export(spark: SparkSession, folder: str, version: int | None = None) -> dict[str, DataFrame]:
    pointer = Pointer(spark, f"{folder}/{VERSIONS}")
    record = pointer.read(version or pointer.number())
    return {
        name: spark.read.schema(T.StructType.fromJson(r["schema"])).parquet(f"{folder}/{r['path']}")
        for name, r in record.items()
    }
