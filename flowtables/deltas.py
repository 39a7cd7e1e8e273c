"""Continuous joins and groupings of change logs: change logs in, the change log of the result out.

A log has op (I, U, D), a position, a key of its table and values; I and U carry the new row. A batch of a log is turned into signed rows: what
the table held before at the keys of the batch (-1) and what it holds now (+1). A join and a grouping of signed rows are signed rows again,
which come out as I, U and D with the number of the batch.

State is kept in tables of commits: of each key its last row of the log, deleted ones too, so a change that arrives after a later one of its key
changes nothing and a log gives the same result however it is dealt into batches. A batch commits to each table once. One that failed half
way is done again from the versions that it began with, so its output is the same; batches come one at a time, numbered upwards.
Columns called batch, other columns called op than that of the log, and names that begin with __ are not for logs.

A batch reads the state's keys and the rows that it meets, and writes only what changed. State grows with the keys that a log has had; `compact`
of its tables folds their commits between batches.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, LongType, StructType

from flowtables.commits import Table
from flowtables.tables import cut, drop_path, work_dir

SIGN = "__sign"


def same(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Whether all of `a` equal all of `b`; null equals null."""
    return reduce(lambda x, y: x & y, [x.eqNullSafe(y) for x, y in zip(a, b, strict=True)])


class Side:
    """The table that a change log leads to, as of each batch."""

    def __init__(self, spark: SparkSession, root: str, key: Sequence[str], position: str, op: str = "op"):
        self.table, self.key, self.position, self.op = Table(spark, root), list(key), position, op

    def current(self, like: StructType, version: int) -> DataFrame:
        """The rows that are not deleted, without op and position."""
        return self.table.read_or_empty(version, like).where(F.col(self.op) != "D").drop(self.op, self.position)

    def moved(self, log: DataFrame, batch: int) -> DataFrame:
        """The keys whose last row a batch changes: `__last`, the row of the log, with `__old` and `__new`, the rows before and after, null where there is none."""
        names = log.columns
        values = [c for c in names if c not in (self.op, self.position)]
        rest = [c for c in names if c not in self.key]
        order = F.struct(self.position, *[c for c in sorted(rest) if c != self.position])
        last = log.groupBy(*self.key).agg(F.max_by(F.struct(*names), order).alias("__last"))
        held = self.table.read_or_empty(self.table.before(batch), log.schema).select(F.struct(*names).alias("__held"))
        both = last.join(held, same([F.col(k) for k in self.key], [F.col(f"__held.{k}") for k in self.key]), "left")
        newer = F.col("__held").isNull() | (F.col(f"__last.{self.position}") > F.col(f"__held.{self.position}"))

        def row(of: str) -> Column:
            return F.when(F.col(f"{of}.{self.op}") != "D", F.struct(*[F.col(f"{of}.{v}").alias(v) for v in values]))

        return both.where(newer).select("__last", row("__held").alias("__old"), row("__last").alias("__new"))

    def commit(self, moved: DataFrame, batch: int) -> None:
        self.table.upsert(moved.select("__last.*"), self.key, [self.position], batch=batch, unique=True)


def signed(moved: DataFrame) -> DataFrame:
    """The rows that go (-1) and come (+1); a key whose row stays as it was has none."""
    pair = F.array(F.struct(F.lit(-1).alias(SIGN), F.col("__old").alias("row")), F.struct(F.lit(1).alias(SIGN), F.col("__new").alias("row")))
    changed = moved.where(~F.col("__old").eqNullSafe(F.col("__new"))).select(F.explode(pair).alias("s"))
    return changed.where("s.row is not null").select(f"s.{SIGN}", "s.row.*")


def as_changes(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Signed rows, each key of which goes and comes once at most in sum, as op, keys and values: I and U with the new values, D with the old."""
    values = [c for c in rows.columns if c not in (SIGN, *keys)]
    dealt = rows.repartition(*keys)  # both groupings below go by it
    net = dealt.groupBy(*keys, *values).agg(F.sum(SIGN).alias(SIGN)).where(f"{SIGN} != 0")
    row = F.struct(F.lit(True).alias("__there"), *values)
    both = net.groupBy(*keys).agg(F.max(F.when(F.col(SIGN) < 0, row)).alias("__old"), F.max(F.when(F.col(SIGN) > 0, row)).alias("__new"))
    op = F.when(F.col("__old").isNull(), "I").when(F.col("__new").isNull(), "D").otherwise("U")
    shown = F.coalesce("__new", "__old")
    return both.select(op.alias("op"), *keys, *[shown[v].alias(v) for v in values])


class ChangeOutput:
    """The change log that an operator puts out, a commit a batch."""

    out: Table

    def _put(self, changes: DataFrame, batch: int) -> None:
        self.out.append_once(changes.withColumn("batch", F.lit(batch).cast(LongType())), batch)

    def changes(self) -> DataFrame:
        """op, keys, values and batch of all that has come out; FileNotFoundError before the first batch."""
        return self.out.read()

    def result(self) -> DataFrame:
        """The table that the output leads to."""
        log = self.changes()
        rest = [c for c in log.columns if c not in self.keys]
        last = log.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), "batch").alias("__last")).select(*self.keys, "__last.*")
        return last.where("op != 'D'").drop("op", "batch")


class ChangeJoin(ChangeOutput):
    """The inner join of two change-captured tables on `on`, pairs of a left and a right column, as a change log.

    A batch joins what has changed on the left with the right table as it was, and the left table as it is with what has changed on the right, so
    unchanged rows never meet unchanged rows. Column names of the two sides must differ, but for op and position; the keys of the result are
    those of both. Nulls in `on` meet nothing, null keys are keys like others. An empty batch puts out nothing.
    """

    def __init__(self, spark: SparkSession, root: str, left: Sequence[str], right: Sequence[str], on: Sequence[tuple[str, str]], position: str, op: str = "op"):
        self.left, self.right = Side(spark, f"{root}/left", left, position, op), Side(spark, f"{root}/right", right, position, op)
        self.out, self.on, self.keys = Table(spark, f"{root}/out"), list(on), [*left, *right]

    def step(self, left: DataFrame, right: DataFrame, batch: int) -> None:
        """Take a batch of both logs; one that has been taken already does nothing."""
        if self.out.has_batch(batch):
            return
        if both := (set(left.columns) & set(right.columns)) - {self.left.op, self.left.position}:
            raise ValueError(f"columns on both sides: {sorted(both)}")
        spark, folder = left.sparkSession, work_dir(left.sparkSession)
        was = self.right.table.before(batch)
        l_moved, r_moved = cut(self.left.moved(left, batch), folder), cut(self.right.moved(right, batch), folder)
        self.left.commit(l_moved, batch)
        self.right.commit(r_moved, batch)
        now = self.left.table.before(batch) + 1
        match = reduce(lambda a, b: a & b, [F.col(a) == F.col(b) for a, b in self.on])
        new_left = signed(l_moved).join(self.right.current(right.schema, was), match)
        new_right = self.left.current(left.schema, now).join(signed(r_moved), match)
        self._put(as_changes(new_left.unionByName(new_right), self.keys), batch)
        drop_path(spark, folder)


class ChangeGroup(ChangeOutput):
    """Counts, sums, averages, minima and maxima per group of a change-captured table, as a change log.

    `measures` says name: (kind, column) with kind count, sum, avg, min or max; count of "*" counts rows. Counts and sums follow from the signed
    rows alone. A group is read again only if a row went that held its minimum or maximum, or a value that is not finite. Sums of whole
    numbers and decimals are exact, those of doubles exact but for rounding. Null groups are groups like others; a group without rows goes. An empty batch puts out nothing.
    """

    KINDS = ("count", "sum", "avg", "min", "max")

    def __init__(self, spark: SparkSession, root: str, key: Sequence[str], groups: Sequence[str], measures: dict[str, tuple[str, str]], position: str, op: str = "op"):
        for name, (kind, column) in measures.items():
            if kind not in self.KINDS or (column == "*" and kind != "count"):
                raise ValueError(f"{name}: no {kind} of {column}")
        if not groups:
            raise ValueError("no groups; a column of one value makes one group of all rows")
        self.side, self.out = Side(spark, f"{root}/rows", key, position, op), Table(spark, f"{root}/out")
        self.state, self.keys, self.measures = Table(spark, f"{root}/groups"), list(groups), dict(measures)
        self.columns = sorted({c for kind, c in measures.values() if c != "*"})

    def _parts(self, sign: Column) -> list[Column]:
        """What is kept of a group, from its rows; with their signs, what is added to it."""
        out = [F.sum(sign).cast(LongType()).alias("__rows")]
        kinds = {c: {k for k, of in self.measures.values() if of == c} for c in self.columns}
        for i, c in enumerate(self.columns):
            out.append(F.sum(F.when(F.col(c).isNull(), 0).otherwise(sign)).cast(LongType()).alias(f"__n{i}"))
            if kinds[c] & {"sum", "avg"}:
                out.append(F.sum(F.when(sign < 0, -F.col(c)).otherwise(F.col(c))).alias(f"__sum{i}"))
            if kinds[c] & {"min", "max"}:
                came = F.when(sign > 0, F.col(c))
                out += [F.min(came).alias(f"__min{i}"), F.max(came).alias(f"__max{i}")]
        return out

    def _again(self, schema: StructType) -> list[Column]:
        """Of the rows that go: least and largest value, and whether one is not finite."""
        out, odd = [], F.lit(False)
        for i, c in enumerate(self.columns):
            gone = F.when(F.col(SIGN) < 0, F.col(c))
            if any(k in ("min", "max") for k, of in self.measures.values() if of == c):
                out += [F.min(gone).alias(f"__low{i}"), F.max(gone).alias(f"__high{i}")]
            if isinstance(schema[c].dataType, (DoubleType, FloatType)):
                odd = odd | F.isnan(c) | (F.abs(c) == float("inf"))
        return [*out, F.coalesce(F.bool_or(F.when(F.col(SIGN) < 0, odd)), F.lit(False)).alias("__odd")]

    def _shown(self, of: str) -> list[Column]:
        """The measures, from what is kept."""
        out = []
        for name, (kind, c) in self.measures.items():
            i = None if c == "*" else self.columns.index(c)
            n = F.col(f"{of}.__rows") if i is None else F.col(f"{of}.__n{i}")
            value = n if kind == "count" else F.when(n > 0, F.col(f"{of}.__sum{i}") / n if kind == "avg" else F.col(f"{of}.__{kind}{i}"))
            out.append(value.alias(name))
        return out

    def step(self, log: DataFrame, batch: int) -> None:
        """Take a batch of the log; one that has been taken already does nothing. Fit for foreachBatch."""
        if self.out.has_batch(batch):
            return
        spark, folder, keys = log.sparkSession, work_dir(log.sparkSession), self.keys
        moved = cut(self.side.moved(log, batch), folder)
        self.side.commit(moved, batch)
        rows = self.side.current(log.schema, self.side.table.before(batch) + 1)
        whole = rows.groupBy(*keys).agg(*self._parts(F.lit(1)))
        names = whole.columns[len(keys):]
        held = self.state.read_or_empty(self.state.before(batch), whole.schema)
        held = held.select(F.struct(*whole.columns).alias("__old"))
        delta = signed(moved).groupBy(*keys).agg(*self._parts(F.col(SIGN)), *self._again(log.schema))
        both = delta.join(held, same([F.col(k) for k in keys], [F.col(f"__old.{k}") for k in keys]), "left")
        again, sums = F.col("__odd"), []
        for name in names:
            old, kind = F.col(f"__old.{name}"), whole.schema[name].dataType
            if name.startswith("__min"):
                again = again | F.coalesce(F.col(name.replace("min", "low")) <= old, F.lit(False))
                value = F.least(old, name)
            elif name.startswith("__max"):
                again = again | F.coalesce(F.col(name.replace("max", "high")) >= old, F.lit(False))
                value = F.greatest(old, name)
            else:
                value = F.when(old.isNull(), F.col(name)).when(F.col(name).isNull(), old).otherwise(old + F.col(name))
            sums.append(value.cast(kind).alias(name))
        stepped = cut(both.select(*keys, "__old", F.struct(*sums).alias("__new"), again.alias("__again")), folder)
        asked = stepped.where("__again and __new.__rows > 0").select(*[F.col(k).alias(f"__{k}") for k in keys])
        match = same([F.col(k) for k in keys], [F.col(f"__{k}") for k in keys])
        reread = rows.join(asked, match, "left_semi").groupBy(*keys).agg(*self._parts(F.lit(1)))
        fresh = reread.select(*[F.col(k).alias(f"__{k}") for k in keys], F.struct(*names).alias("__fresh"))
        final = cut(stepped.join(fresh, match, "left").select(*keys, "__old", F.coalesce("__fresh", "__new").alias("__new")), folder)
        kept = final.select(*keys, "__new.*", (F.col("__new.__rows") <= 0).alias("__gone"))
        self.state.upsert(kept, keys, ["__rows"], batch=batch, delete="__gone", unique=True)
        old, new = final.where("__old is not null"), final.where("__new.__rows > 0")
        out = old.select(F.lit(-1).alias(SIGN), *keys, *self._shown("__old")).union(new.select(F.lit(1).alias(SIGN), *keys, *self._shown("__new")))
        self._put(as_changes(out, keys), batch)
        drop_path(spark, folder)


__all__ = ["ChangeGroup", "ChangeJoin", "ChangeOutput", "Side", "as_changes", "signed"]
