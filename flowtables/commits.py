"""Tables as a log of commits: files first, then one small manifest that makes them count.

A table is a folder with `data/` and `commits/`. A writer puts its rows into a data folder of its own and then creates the manifest of the
next version, which names that folder; creating a file that exists fails, so of two writers only one gets a version. Readers list the
manifests and read what these name, so files of a writer that failed or has not finished are never seen. A manifest is JSON:

    version, batch (the writer's batch id or null), mode (append or overwrite), folder, rows are {"add": bool, "delete": bool}, key

Nothing that is read is ever written over. A commit's rows may be accompanied by the keys that they replace (upsert): reading keeps of
each key the rows that no later commit deletes. `compact` folds all of that into one overwrite commit.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

VERSION, DIGITS, TRIES = "__version", 20, 100


class BatchAlreadyCommitted(Exception):
    """The table has this batch already; nothing has been written to it."""


@dataclass(frozen=True)
class Commit:
    version: int
    batch: str | None
    mode: str
    folder: str
    delete: bool
    key: tuple[str, ...]
    schema: str


class _Files:
    """The few file operations of a log, on whatever store Spark writes to."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path
        self.conf, self.gateway = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._gateway
        self.fs = self.path(root).getFileSystem(self.conf)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, file: str) -> str:
        stream = self.fs.open(self.path(file))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, file: str, text: str) -> bool:
        """Whether the file was made, whole, by this call: it is written under another name, and renaming does not replace a file."""
        draft = f"{file}.{uuid.uuid4().hex}.tmp"
        stream = self.fs.create(self.path(draft), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path(file).toUri(), self.conf)
        nothing = self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(self.path(draft), self.path(file), nothing)
            return True
        except Py4JJavaError as error:
            self.fs.delete(self.path(draft), False)
            if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            return False


class Table:
    """A table of commits under `root`."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = _Files(spark, self.root)

    # the log

    def commits(self, upto: int | None = None) -> list[Commit]:
        """The commits in order; none of a table that does not exist. There is one small manifest a commit."""
        out = []
        for name in self.files.names(f"{self.root}/commits"):
            if name.endswith(".json") and (upto is None or int(name[:DIGITS]) <= upto):
                said = json.loads(self.files.read(f"{self.root}/commits/{name}"))
                out.append(Commit(int(name[:DIGITS]), said["batch"], said["mode"], said["folder"], said["delete"], tuple(said["key"]), said["schema"]))
        return out

    def version(self) -> int:
        """The last version, -1 without any."""
        return max((c.version for c in self.commits()), default=-1)

    def has_batch(self, batch: str | int, writer: str = "") -> bool:
        return f"{writer}:{batch}" in {c.batch for c in self.commits()}

    def before(self, batch: str | int, writer: str = "") -> int:
        """The version that a batch begins with: the one before its commit if it has been taken, else the last."""
        return next((c.version - 1 for c in self.commits() if c.batch == f"{writer}:{batch}"), self.version())

    def read_or_empty(self, version: int, like: StructType) -> DataFrame:
        """The columns of `like` as of a version; no rows before the first."""
        return self.read(version).select(*like.names) if version >= 0 else self.spark.createDataFrame([], like)

    def _commit(self, folder: str, schema: StructType, *, mode: str, batch: str | None, delete: bool = False, key: tuple[str, ...] = (), expect: int | None = None) -> int:
        said = {"batch": batch, "mode": mode, "folder": folder, "delete": delete, "key": list(key), "schema": schema.json()}
        for _ in range(TRIES):
            known = self.commits()
            if batch is not None and batch in {c.batch for c in known}:
                raise BatchAlreadyCommitted(batch)
            last = max((c.version for c in known), default=-1)
            if expect is not None and last != expect:
                raise RuntimeError(f"the table is at version {last}, not {expect}")
            if self.files.create(f"{self.root}/commits/{last + 1:0{DIGITS}d}.json", json.dumps(said)):
                return last + 1
        raise RuntimeError("no version could be taken")

    def _write(self, df: DataFrame, part: str = "add", folder: str | None = None) -> str:
        folder = folder or uuid.uuid4().hex
        df.write.parquet(f"{self.root}/data/{folder}/{part}")
        return folder

    # writing

    def append(self, df: DataFrame) -> int:
        """Add rows: at least once, as a repeated call adds them again."""
        return self._commit(self._write(df), df.schema, mode="append", batch=None)

    def append_once(self, df: DataFrame, batch: str | int, writer: str = "") -> int | None:
        """Add a writer's batch exactly once: a batch that the log has is not written again, and one that failed before its commit leaves nothing."""
        return self._once(df, "append", f"{writer}:{batch}")

    def overwrite(self, df: DataFrame) -> int:
        """Replace the rows; readers of an earlier version keep theirs."""
        return self._commit(self._write(df), df.schema, mode="overwrite", batch=None)

    def overwrite_once(self, df: DataFrame, batch: str | int, writer: str = "") -> int | None:
        """Replace the rows by a batch, exactly once."""
        return self._once(df, "overwrite", f"{writer}:{batch}")

    def _once(self, df: DataFrame, mode: str, batch: str) -> int | None:
        if batch in {c.batch for c in self.commits()}:
            return None
        try:
            return self._commit(self._write(df), df.schema, mode=mode, batch=batch)
        except BatchAlreadyCommitted:
            return None

    def upsert(self, df: DataFrame, key: list[str], order: list[str], *, batch: str | int | None = None, writer: str = "", delete: str | None = None, unique: bool = False) -> int | None:
        """Put in each key's last row by `order` and delete the rows of these keys that earlier commits hold; no old file is read or rewritten.

        Keys may be null: null is a key like others. Rows equal in key and order are ordered by all their columns, so the result does not
        depend on how they are dealt. Where the boolean column `delete` is true the key goes and no row comes in its place; the column is not kept.
        With `unique` the caller vouches that `df` has each key once and is cheap to read twice, such as a written table; then nothing is shuffled.
        """
        name = None if batch is None else f"{writer}:{batch}"
        if name is not None and name in {c.batch for c in self.commits()}:
            return None
        folder = uuid.uuid4().hex
        written = df if unique else self._last_rows(df, key, order, folder)
        kept = written.where(~F.coalesce(F.col(delete), F.lit(False))).drop(delete) if delete else written
        self._write(kept, "add", folder)
        self._write(written.select(*key), "gone", folder)
        try:
            return self._commit(folder, kept.schema, mode="append", batch=name, delete=True, key=tuple(key))
        except BatchAlreadyCommitted:
            return None

    def _last_rows(self, df: DataFrame, key: list[str], order: list[str], folder: str) -> DataFrame:
        """Each key's last row, written."""
        rest = [c for c in df.columns if c not in key]
        at = F.struct(*order, *[c for c in sorted(rest) if c not in order])
        last = df.groupBy(*key).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), at).alias("__last")) if rest else df.select(*key).distinct()
        last = last.select(*key, "__last.*").select(*df.columns) if rest else last
        self._write(last, "all", folder)
        return self.spark.read.schema(last.schema).parquet(f"{self.root}/data/{folder}/all")

    def compact(self) -> int | None:
        """One commit with the rows of all; fails, without harm, if another writer commits meanwhile."""
        at = self.version()
        if at < 0:
            return None
        rows = self.read(at)
        return self._commit(self._write(rows.hint("rebalance")), rows.schema, mode="overwrite", batch=None, expect=at)

    # reading

    def _live(self, upto: int | None) -> list[Commit]:
        known = self.commits(upto)
        last = max((i for i, c in enumerate(known) if c.mode == "overwrite"), default=0)
        return known[last:]

    def _part(self, commits: list[Commit], part: str, schema: StructType) -> DataFrame:
        """The rows of some commits' folders with their version, from one scan."""
        paths = [f"{self.root}/data/{c.folder}/{part}" for c in commits]
        rows = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        numbers = F.create_map(*[F.lit(x) for c in commits for x in (c.folder, c.version)]) if commits else F.create_map(F.lit(""), F.lit(-1))
        folder = F.element_at(F.split(F.input_file_name(), "/"), -3)
        return rows.withColumn(VERSION, F.element_at(numbers, folder).cast(LongType()))

    def schema(self, upto: int | None = None) -> StructType:
        """The columns of all commits that count; one that a commit adds is null in the rows before it."""
        fields = {}
        for c in self._live(upto):
            for f in StructType.fromJson(json.loads(c.schema)).fields:
                fields.setdefault(f.name, f)
        return StructType([type(f)(f.name, f.dataType, True) for f in fields.values()])

    def read(self, version: int | None = None, *, with_version: bool = False) -> DataFrame:
        """The table as of a version, the last by default: rows that no later commit's deletes cover.

        A commit without deletes costs nothing to read; with them the rows meet the last deleting version of each key.
        """
        live = self._live(version)
        if not live:
            raise FileNotFoundError(f"no commit in {self.root}")
        schema = self.schema(version)
        rows = self._part(live, "add", schema)
        deletes = [c for c in live if c.delete]
        for key in sorted({c.key for c in deletes}):
            gone = self._part([c for c in deletes if c.key == key], "gone", StructType([schema[k] for k in key]))
            last = gone.groupBy(*[F.col(k).alias(f"__{k}") for k in key]).agg(F.max(VERSION).alias("__gone"))
            match = F.col("__gone") > F.col(VERSION)
            for k in key:
                match &= F.col(k).eqNullSafe(F.col(f"__{k}"))
            rows = rows.join(last, match, "left_anti")
        return rows if with_version else rows.drop(VERSION)

    def added(self, after: int, upto: int | None = None) -> DataFrame:
        """The rows that commits after a version have added, with their version in `version`; -1 is before the first."""
        new = [c for c in self.commits(upto) if c.version > after]
        return self._part(new, "add", self.schema(upto)).withColumnRenamed(VERSION, "version")


def start_after(table: Table, offset: str | int) -> int:
    """The version after which to read: earliest, latest, or a first version to read."""
    if offset == "earliest":
        return -1
    return table.version() if offset == "latest" else int(offset) - 1


def poll(table: Table, after: int, each) -> int:
    """Give the rows of each version after `after`, in order, to each(rows, version); the last version read, from which a later call goes on."""
    for c in table.commits():
        if c.version > after:
            each(table.added(c.version - 1, c.version).drop("version"), c.version)
            after = c.version
    return after



__all__ = ["BatchAlreadyCommitted", "Commit", "Table", "poll", "start_after"]
