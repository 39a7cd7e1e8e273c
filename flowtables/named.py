"""Streams by name: a definition that is kept, run over tables or over streams, and asked for its rows later."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from flowtables.commits import Table
from flowtables.streams import run_available


@dataclass(frozen=True)
class Definition:
    fn: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    keys: tuple[str, ...]


class Streams:
    """Definitions over named sources, and under `root` a table of commits with the rows of each stream that has run.

    A stream without `keys` puts out rows, each batch of them once. One with `keys` is a grouping whose rows change: its table has
    the last row of each key (null is a key). A name that is taken, or an input that is not known, is an error. What has not run yet has no rows.
    """

    def __init__(self, spark: SparkSession, root: str, sources: dict[str, StructType]):
        self.spark, self.root, self.sources = spark, root.rstrip("/"), dict(sources)
        self.streams: dict[str, Definition] = {}

    def define(self, name: str, fn: Callable[..., DataFrame], inputs: Sequence[str], keys: Sequence[str] = ()) -> None:
        """Name a function of its inputs, which are sources or streams defined before."""
        if name in self.sources or name in self.streams:
            raise ValueError(f"{name} is taken")
        if unknown := [i for i in inputs if i not in self.sources and i not in self.streams]:
            raise ValueError(f"{name} reads {', '.join(unknown)}, which nothing defines")
        self.streams[name] = Definition(fn, tuple(inputs), tuple(keys))

    def over(self, name: str, sources: dict[str, DataFrame]) -> DataFrame:
        """A stream, or a source, over given tables or streams of its sources."""
        if name in self.streams:
            made = self.streams[name]
            return made.fn(*[self.over(i, sources) for i in made.inputs])
        return sources[name].select(*self.sources[name].names)

    def schema(self, name: str) -> StructType:
        """A stream's columns by its definition alone; no source is read."""
        return self.over(name, {n: self.spark.createDataFrame([], s) for n, s in self.sources.items()}).schema

    def table(self, name: str) -> Table:
        if name not in self.streams:
            raise ValueError(f"no stream {name}")
        return Table(self.spark, f"{self.root}/{name}/rows")

    def run(self, name: str, sources: dict[str, DataFrame]) -> None:
        """Read what is new in streams of the sources into the stream's table; a later call goes on where this one ended."""
        made, table = self.streams[name], self.table(name)

        def each(batch: DataFrame, number: int) -> None:
            if made.keys:
                table.upsert(batch, list(made.keys), [], batch=number)
            else:
                table.append_once(batch, number)

        run_available(self.over(name, sources), each, f"{self.root}/{name}/checkpoint", "update" if made.keys else "append")

    def ask(self, name: str, where: str | Column | None = None, *, version: int | None = None) -> DataFrame:
        """The rows of a stream as it stands, or stood at a version of its table, that meet a condition on its output columns."""
        table = self.table(name)
        rows = table.read_or_empty(table.version() if version is None else version, self.schema(name))
        return rows if where is None else rows.where(where)
