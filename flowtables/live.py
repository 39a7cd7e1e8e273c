"""What a running stream keeps from batch to batch, as tables of commits: late rows, open sessions, the last rows of each key.

Each class has step(batch, number), fit for foreachBatch: a batch counts once however often it is delivered, and one that failed half way is
done again from what was there before it. Batches come one at a time, numbered upwards. Names that begin with __ are not for rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from flowtables import windows
from flowtables.commits import Table
from flowtables.deltas import SIGN, ChangeOutput, as_changes, same
from flowtables.ordered import running_max
from flowtables.tables import cut, drop_path, work_dir


class Lateness:
    """Rows on time and late rows in two tables, `on_time` and `late`, each with the watermark that it met, and the counts of each batch in `progress`.

    A row is late if `closes`, when its window ends (such as windows.end_of, by default the time `ts` itself), is not after the watermark. That is the largest time
    of the batches before less `delay`; or, with `sent` and `pos`, the largest that the producer has sent up to the row: control
    rows carry a watermark in `sent`, others null, and `pos` is a row's place among all that come, whole numbers without repeats. Rows without
    a time are on time, and so is all that comes before the first watermark. On time and late rows are all rows but the control rows.
    """

    def __init__(self, spark: SparkSession, root: str, ts: str, *, delay: str = "0 seconds", closes: Column | None = None, sent: str | None = None, pos: str | None = None):
        if (sent is None) != (pos is None):
            raise ValueError("sent and pos go together")
        self.on_time, self.late, self.progress = (Table(spark, f"{root}/{n}") for n in ("on_time", "late", "progress"))
        self.ts, self.delay, self.closes, self.sent, self.pos = ts, delay, F.col(ts) if closes is None else closes, sent, pos

    def watermark(self, number: int, kind: DataType) -> Column:
        """The watermark that batch `number` begins with, as a constant; null before the first."""
        at = self.progress.before(number)
        if at < 0:
            return F.lit(None).cast(kind)
        top = F.max("sent") if self.sent else F.max("top") - F.expr(f"interval {self.delay}")
        said = self.progress.read(at).agg(top.cast("string").alias("w")).first()["w"]  # one value
        return F.lit(said).cast(kind)

    def step(self, batch: DataFrame, number: int) -> None:
        if self.progress.has_batch(number):
            return
        folder, kind = work_dir(batch.sparkSession), batch.schema[self.ts].dataType
        before = self.watermark(number, kind)
        rows = running_max(batch, self.sent, "__sent", self.pos) if self.sent else batch.withColumn("__sent", F.lit(None).cast(kind))
        mark = F.coalesce(F.greatest(before, "__sent"), before)
        rows = rows.withColumn("watermark", mark).withColumn("__late", F.coalesce(self.closes <= F.col("watermark"), F.lit(False))).drop("__sent")
        marked = cut(rows, folder)
        data = F.col(self.sent).isNull() if self.sent else F.lit(True)
        out = marked.where(data).drop(*([self.sent] if self.sent else []))
        self.on_time.append_once(out.where(~F.col("__late")).drop("__late"), number)
        self.late.append_once(out.where("__late").drop("__late"), number)
        sent = F.max(self.sent) if self.sent else F.lit(None).cast(kind)
        counts = marked.agg(F.count_if(data).alias("n"), F.count_if(data & ~F.col("__late")).alias("on_time"), F.count_if(data & F.col("__late")).alias("late"),
            F.max(F.when(data, F.col(self.ts))).alias("top"), sent.alias("sent"))
        self.progress.append_once(counts.select(F.lit(number).cast("long").alias("batch"), "*", before.alias("watermark")), number)
        drop_path(batch.sparkSession, folder)


class SessionChanges(ChangeOutput):
    """Sessions per key as a change log, for rows in any order: a row may begin a session, make one longer or join several.

    Rows at most `gap` apart are one session, from its first time to `gap` after its last. `measures` says name: (kind, column) with kind
    count, sum, min or max. The key of the result is `keys` and window_start: where a session begins earlier than before or is joined to
    another, the old one goes (D) and the new one comes (I). Rows without a time are left out. Only sessions that a batch touches are read
    into its join; those of one key and batch are merged in one task, so keys must be fine-grained, as for windows.session.
    """

    COMBINE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
    FIRST = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}

    def __init__(self, spark: SparkSession, root: str, ts: str, gap: str, keys: Sequence[str], measures: dict[str, tuple[str, str]]):
        if odd := {kind for kind, _ in measures.values()} - set(self.COMBINE):
            raise ValueError(f"no {sorted(odd)}")
        self.state, self.out = Table(spark, f"{root}/sessions"), Table(spark, f"{root}/out")
        self.ts, self.gap, self.by, self.measures = ts, gap, list(keys), dict(measures)
        self.keys = [*keys, "window_start"]

    def step(self, batch: DataFrame, number: int, watermark: Column | None = None) -> None:
        """Take a batch. With a watermark, which no later row's time may be `gap` or more behind, sessions out of reach leave the state; they stay in the output."""
        if self.out.has_batch(number):
            return
        spark, folder = batch.sparkSession, work_dir(batch.sparkSession)
        fresh = windows.session(batch, self.ts, gap=self.gap, keys=self.by, aggs=[self.FIRST[kind](c).alias(name) for name, (kind, c) in self.measures.items()])
        fresh = cut(fresh, folder)
        held = self.state.read_or_empty(self.state.before(number), fresh.schema)
        new = fresh.select(*[F.col(k).alias(f"__{k}") for k in self.by], F.col("window_start").alias("__from"), F.col("window_end").alias("__to"))
        meets = (F.col("window_start") <= F.col("__to")) & (F.col("window_end") >= F.col("__from"))
        if self.by:
            meets &= same([F.col(k) for k in self.by], [F.col(f"__{k}") for k in self.by])
        touched = cut(held.join(new, meets, "left_semi"), folder)
        order = Window.partitionBy(*self.by).orderBy("window_start", "window_end")
        begins = F.coalesce(F.col("window_start") > F.max("window_end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
        numbered = touched.unionByName(fresh).withColumn("__begins", begins.cast("int")).withColumn("__session", F.sum("__begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        sums = [self.COMBINE[kind](name).cast(fresh.schema[name].dataType).alias(name) for name, (kind, _) in self.measures.items()]
        merged = numbered.groupBy(*self.by, "__session").agg(F.min("window_start").alias("window_start"), F.max("window_end").alias("window_end"), *sums).select(*fresh.columns)
        signs = touched.withColumn(SIGN, F.lit(-1)).unionByName(merged.withColumn(SIGN, F.lit(1)))
        changed = cut(as_changes(signs, self.keys), folder)
        stored = changed.withColumn("__gone", F.col("op") == "D").drop("op")
        if watermark is not None:
            passed = F.coalesce(F.col("window_end") <= watermark - F.expr(f"interval {self.gap}"), F.lit(False))
            old = held.where(passed).withColumn("__gone", F.lit(True))
            stored = stored.withColumn("__gone", F.col("__gone") | passed).unionByName(old)
        self.state.upsert(stored, self.keys, ["window_end"], batch=number, delete="__gone", unique=True)
        self._put(changed, number)
        drop_path(spark, folder)


class LastRows:
    """The last `n` rows of each key by `order`, for readers that come late; `back` is 1 for the last. Null keys are keys, null orders the first of all.

    Rows equal in `order` are ordered by all their columns. The state has at most `n` rows a key; a batch is cut down to these before it meets it.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], order: Sequence[str], n: int):
        self.table, self.keys, self.order, self.n = Table(spark, root), list(keys), list(order), n

    def _last(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in sorted(rows.columns) if c not in (*self.keys, *self.order, "back")]
        by = Window.partitionBy(*self.keys).orderBy(*[F.desc(c) for c in (*self.order, *rest)])
        return rows.withColumn("back", F.row_number().over(by).cast("long")).where(F.col("back") <= self.n)

    def step(self, batch: DataFrame, number: int) -> None:
        if self.table.has_batch(number):
            return
        folder = work_dir(batch.sparkSession)
        some = cut(self._last(batch), folder)
        held = self.table.read_or_empty(self.table.before(number), some.schema)
        asked = some.where("back = 1").select(*[F.col(k).alias(f"__{k}") for k in self.keys])
        touched = held.join(asked, same([F.col(k) for k in self.keys], [F.col(f"__{k}") for k in self.keys]), "left_semi")
        last = cut(self._last(some.unionByName(touched).drop("back")), folder)
        self.table.upsert(last, [*self.keys, "back"], ["back"], batch=number, unique=True)
        drop_path(batch.sparkSession, folder)

    def read(self) -> DataFrame:
        return self.table.read()


__all__ = ["LastRows", "Lateness", "SessionChanges"]


class Lookup:
    """The rows of a stream with the columns of a reference table that changes, each batch as of one version of it, in `out` with the version used.

    The version is the reference's last one when the batch first comes and is written down before the join, so a batch that is done
    again gets the same rows. `like` is the reference's schema, as it may have no version yet. Rows without a match, null keys among
    them, stay with nulls; a key that the reference has several times gives a row for each.
    """

    def __init__(self, spark: SparkSession, root: str, reference: Table, like: StructType, on: Sequence[str]):
        self.reference, self.like, self.on = reference, like, list(on)
        self.out, self.pins = Table(spark, f"{root}/out"), Table(spark, f"{root}/pins")

    def pinned(self, number: int) -> int:
        """The version of the reference that a batch is joined with."""
        pin = self.pins.spark.createDataFrame([(number, self.reference.version())], "batch long, version long")
        self.pins.append_once(pin, number)
        return self.pins.read().where(F.col("batch") == number).first()["version"]  # one row

    def step(self, batch: DataFrame, number: int) -> None:
        if self.out.has_batch(number):
            return
        if clash := [c for c in (*self.like.names, "version") if c in batch.columns and c not in self.on]:
            raise ValueError(f"both sides have {', '.join(clash)}")
        at = self.pinned(number)
        joined = batch.join(self.reference.read_or_empty(at, self.like), self.on, "left")
        self.out.append_once(joined.withColumn("version", F.lit(at).cast("long")), number)
