"""Stored tables whose versions are lists of files: written once, committed together, and read as one of the versions.

``files/<part>/…`` holds data files that never change, ``versions/<number>.json`` the list of the files of each version. A commit is the
rename of one such list, so readers see all of it or nothing, and what a failed writer leaves behind belongs to no version.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FILE = "_file"


class Part(NamedTuple):
    """Files that were written by one job, and the number of their rows."""

    files: list[str]
    rows: int


class Version(NamedTuple):
    """What a version holds: per table its schema and parts, and the last epoch of a stream that went into it."""

    number: int
    epoch: int
    schemas: dict[str, str]
    tables: dict[str, list[Part]]


class Conflict(RuntimeError):
    """Another writer has committed the version that this one was about to."""


class Store:
    """One or more tables under a folder that all executors see, with one list of versions for all of them.

    The lists go through the driver, as the list of files of any scan does; rows never do.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _fs(self):
        return self._at("").getFileSystem(self._conf) if self.path else None

    # ---- versions ------------------------------------------------------------------------------------------------

    def versions(self) -> list[int]:
        folder, fs = self._at("versions"), self._fs()
        if not fs.exists(folder):
            return []
        names = [entry.getPath().getName() for entry in fs.listStatus(folder)]
        return sorted(int(name[:-5]) for name in names if name.endswith(".json") and not name.startswith("."))

    def version(self, number: int | None = None) -> Version:
        """A version, by default the newest; number 0 is the empty one."""
        if number is None:
            number = max(self.versions(), default=0)
        if number == 0:
            return Version(0, -1, {}, {})
        stream = self._fs().open(self._at(f"versions/{number:020d}.json"))
        try:
            found = json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        tables = {name: [Part(*part) for part in parts] for name, parts in found["tables"].items()}
        return Version(number, found["epoch"], found["schemas"], tables)

    def commit(self, base: Version, tables: dict[str, list[Part]], schemas: dict[str, StructType] | None = None, epoch: int | None = None) -> Version:
        """Make the version after ``base``: the named tables get these parts, all others keep theirs."""
        kinds = base.schemas | {name: schema.json() for name, schema in (schemas or {}).items()}
        new = Version(base.number + 1, base.epoch if epoch is None else epoch, kinds, base.tables | tables)
        text = json.dumps({"epoch": new.epoch, "schemas": new.schemas, "tables": new.tables})
        fs, draft = self._fs(), self._at(f"versions/.{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        options = self._jvm.org.apache.hadoop.fs.Options.Rename
        never_over = self.spark.sparkContext._gateway.new_array(options, 1)
        never_over[0] = options.NONE
        target = self._at(f"versions/{new.number:020d}.json")
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf).rename(draft, target, never_over)
        except Exception as error:
            fs.delete(draft, False)
            if fs.exists(target):
                raise Conflict(f"version {new.number} of {self.path} was committed by another writer") from error
            raise
        return new

    # ---- files ---------------------------------------------------------------------------------------------------

    def write(self, rows: DataFrame) -> Part:
        """Write data files that belong to no version yet."""
        folder = f"files/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{folder}")
        stored = self.spark.read.schema(rows.schema).parquet(f"{self.path}/{folder}")
        names = sorted(f"{folder}/{name.rsplit('/', 1)[1]}" for name in stored.inputFiles())
        return Part(names, stored.count())

    def discard(self, part: Part) -> None:
        """Delete files that were written but are in no version."""
        self._fs().delete(self._at(part.files[0].rsplit("/", 1)[0]), True)

    def read(self, table: str, version: Version | None = None, parts: list[Part] | None = None) -> DataFrame:
        """Rows of a table in a version, by default the newest, or of some of its parts."""
        version = version or self.version()
        if table not in version.schemas:
            raise KeyError(f"no table {table} in {self.path}")
        schema = StructType.fromJson(json.loads(version.schemas[table]))
        parts = version.tables[table] if parts is None else parts
        files = [f"{self.path}/{name}" for part in parts for name in part.files]
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)

    def vacuum(self, keep: int = 1, grace: float = 24 * 3600) -> list[str]:
        """Delete lists before the newest ``keep`` versions, and files in none of these that are older than ``grace`` seconds.

        The time of grace spares what writers at work have not committed and what readers still read.
        """
        kept = self.versions()[-keep:]
        held = {name for n in kept for parts in self.version(n).tables.values() for part in parts for name in part.files}
        fs, before, gone = self._fs(), (time.time() - grace) * 1000, []
        for number in self.versions():
            if number < min(kept):
                fs.delete(self._at(f"versions/{number:020d}.json"), False)
        for folder in fs.listStatus(self._at("files")) if fs.exists(self._at("files")) else []:
            names = [entry for entry in fs.listStatus(folder.getPath()) if entry.getPath().getName().endswith(".parquet")]
            stale = [entry for entry in names if f"files/{folder.getPath().getName()}/{entry.getPath().getName()}" not in held and entry.getModificationTime() <= before]
            for entry in stale:
                fs.delete(entry.getPath(), False)
                gone.append(f"files/{folder.getPath().getName()}/{entry.getPath().getName()}")
            if len(stale) == len(names) and folder.getModificationTime() <= before:
                fs.delete(folder.getPath(), True)
        return gone

    # ---- changes -------------------------------------------------------------------------------------------------

    def append(self, table: str, rows: DataFrame, epoch: int | None = None) -> Version:
        """Add rows; an epoch that is already in the store is not added again."""
        return self.append_all({table: rows}, epoch)

    def append_all(self, rows: dict[str, DataFrame], epoch: int | None = None) -> Version:
        """Add rows to several tables in one commit: after a failure all have them or none."""
        base = self.version()
        if epoch is not None and epoch <= base.epoch:
            return base
        parts = {name: [*base.tables.get(name, []), self.write(df)] for name, df in rows.items()}
        return self.commit(base, parts, {name: df.schema for name, df in rows.items()}, epoch)

    def rewrite(self, table: str, touched: Callable[[DataFrame], DataFrame], change: Callable[[DataFrame], DataFrame]) -> Version:
        """Copy on write: only files that hold rows of ``touched`` are replaced, by what ``change`` makes of their rows.

        ``touched`` gets all rows with the name of their file in a column ``_file`` and returns the rows to be changed, which only that
        column is taken from. Without any the version stays. Names of files come to the driver, no more than a version lists.
        """
        base = self.version()
        named = self.read(table, base).withColumn(FILE, file_name())
        dirty = {row[0] for row in touched(named).select(FILE).distinct().collect()}
        if not dirty:
            return base
        clean, old = [], []
        for part in base.tables[table]:
            for name in part.files:
                (old if name in dirty else clean).append(name)
        changed = self.write(change(self.read(table, base, [Part(old, 0)])))
        kept = Part(clean, self.read(table, base, [Part(clean, 0)]).count()) if clean else None
        return self.commit(base, {table: [p for p in (kept, changed) if p]})


def file_name() -> Column:
    """The name of a row's file as versions list it."""
    return F.regexp_extract(F.col("_metadata.file_path"), "(files/[^/]+/[^/]+)$", 1)


class Generations:
    """A table of a store that grows by small parts and is read as their combination.

    ``combine`` makes one frame of the rows of several parts, such as the newest row of each key or the sum of its changes; the order in
    which parts are combined must not matter. Two neighbours are merged as soon as the older is less than twice as large
    as the newer, so the number of parts is logarithmic, and each row is rewritten as often as that.
    """

    def __init__(self, store: Store, table: str, combine: Callable[[DataFrame], DataFrame]):
        self.store, self.table, self.combine = store, table, combine

    def parts(self, version: Version) -> list[Part]:
        return version.tables.get(self.table, [])

    def added(self, version: Version, rows: DataFrame) -> list[Part]:
        """The parts with ``rows`` added, to be committed; without rows they stay as they are."""
        new = self.store.write(rows)
        if not new.rows and self.table in version.schemas:
            self.store.discard(new)
            return self.parts(version)
        parts = [*self.parts(version), new]
        schemas = version._replace(schemas={**version.schemas, self.table: rows.schema.json()})
        while len(parts) > 1 and parts[-2].rows < 2 * parts[-1].rows:
            merged = self.combine(self.store.read(self.table, schemas, parts[-2:]))
            parts[-2:] = [self.store.write(merged.select(*rows.columns))]
        return parts

    def add(self, rows: DataFrame, epoch: int | None = None) -> Version:
        base = self.store.version()
        if epoch is not None and epoch <= base.epoch:
            return base
        parts = self.added(base, rows)
        if self.table in base.schemas and parts == self.parts(base):
            return base  # nothing came: such an epoch makes no version
        return self.store.commit(base, {self.table: parts}, {self.table: rows.schema}, epoch)

    def raw(self, version: Version) -> DataFrame | None:
        """The uncombined rows, None before the first."""
        return self.store.read(self.table, version) if self.table in version.schemas else None

    def read(self, version: Version | None = None) -> DataFrame:
        version = version or self.store.version()
        return self.combine(self.store.read(self.table, version))


def newest(keys: list[str], order: str = "epoch") -> Callable[[DataFrame], DataFrame]:
    """Combination that keeps the newest row of each key."""

    def combine(rows: DataFrame) -> DataFrame:
        others = [c for c in rows.columns if c not in keys]
        return rows.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("_row")).select(*[c if c in keys else F.col(f"_row.{c}") for c in rows.columns])

    return combine


def summed(keys: list[str], values: list[str]) -> Callable[[DataFrame], DataFrame]:
    """Combination that adds up changes; keys whose changes cancel out go."""

    def combine(rows: DataFrame) -> DataFrame:
        total = rows.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])
        return total.where(" or ".join(f"{v} <> 0" for v in values)).select(*rows.columns)

    return combine
