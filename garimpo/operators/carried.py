"""Histories carried forward: a new stretch of days reads the running state and its own rows only.

The functions of ``operators/history.py`` look back over everything before a record. ``CarriedHistory`` feeds
them whole days in their order. What a key has gathered so far enters the running totals as one more event on
the day before the batch, so a hot key is spread over buckets as in a full run and no row is joined to state.

A run publishes, as one entry of the lake's commit log,

* its rows with their history,
* per key, what the run's own days add (partial totals; they are added up when read, so no run rewrites what
  others wrote, and every ``fold_every`` runs they become one folder),
* events that take effect on later days, such as the end of a contract, by the month they are due in. The run
  that covers the day takes them up; a run opens the months it covers.

Days must come whole and in order, from one writer: rows on or before the last day are refused, and of two
writers at once the second meets ``Conflict``. A repeated run does nothing. Results equal those of one
run over all days; sums of doubles may differ in their last digits.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from garimpo.operators.commits import CommitLog, folder_value
from garimpo.operators.running import totals_before

_CARRIED, _AT, _DAY, _DUE, _RUN = "__carried", "__place", "__day_number", "due", "run"
_KEPT_AS = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
_MERGED_BY = {"sum": "sum", "count": "sum", "min": "min", "max": "max"}
EPOCH = date(1970, 1, 1)


class OutOfOrder(ValueError):
    """Rows without a day, or on days that a run before has closed."""


def _month(day: Column) -> Column:
    return F.date_format(F.date_from_unix_date(day), "yyyy-MM")


class _Step:
    """One call of the running totals within a run: its events, what they add, and what stays for later days."""

    def __init__(self, owner: "CarriedHistory", label: str, df: DataFrame, keys, order, measures, bucket: Column, last: int):
        if not all(isinstance(o, str) for o in order):
            raise TypeError("carried totals are ordered by named columns")
        self.owner, self.label, self.keys, self.measures, self.last = owner, label, list(keys), measures, last
        self.names = {m: f"__part_{m}" for m in measures}
        typed = df.select(*(_typed(how, col).alias(m) for m, (how, col) in measures.items()))
        # A partial total has the type of a total, whatever run it comes from.
        kinds = typed.agg(*(_KEPT_AS[how](m).alias(m) for m, (how, _) in measures.items())).schema
        self.events = df.withColumns({
            _AT: bucket, **{self.names[m]: _typed(how, col).cast(kinds[m].dataType) for m, (how, col) in measures.items()}})
        place = self.events.schema[_AT].dataType
        self.fields = place.fields if isinstance(place, T.StructType) else None
        self.events = self.events.withColumn(_DAY, (F.col(_AT)[self.fields[0].name] if self.fields else F.col(_AT)).cast("int"))
        # What a later run needs to know of an event: its key, its place and what it adds.
        self.order = [o for o in dict.fromkeys(order) if o not in self.keys]
        parts = [T.StructField(c, self.events.schema[c].dataType) for c in self.names.values()]
        held = [T.StructField(k, df.schema[k].dataType) for k in self.keys]
        self.totals_schema = T.StructType([*held, *parts, T.StructField(_RUN, T.StringType())])
        placed = [T.StructField(o, df.schema[o].dataType) for o in self.order]
        self.later_schema = T.StructType([
            *held, *placed, T.StructField(_AT, place), T.StructField(_DAY, T.IntegerType()), *parts,
            T.StructField(_DUE, T.StringType()), T.StructField(_RUN, T.StringType())])

    def _keyed(self, df: DataFrame) -> DataFrame:
        return df.dropna(subset=self.keys)

    def _before(self, day: int) -> Column:
        if self.fields is None:
            return F.lit(day).cast(self.events.schema[_AT].dataType)
        first, *rest = self.fields
        return F.struct(
            F.lit(day).cast(first.dataType).alias(first.name), *(F.lit(None).cast(f.dataType).alias(f.name) for f in rest))

    def held(self) -> DataFrame | None:
        """Partial totals of the runs so far, one row per key and run since the last fold."""
        found = self.owner.commits.read(self.owner.totals(self.label), self.totals_schema)
        return None if found is None else found.drop(_RUN)

    def waiting(self) -> DataFrame | None:
        """Events that earlier runs left for days after the last one closed."""
        found = self.owner.commits.read(self.owner.later(self.label), self.later_schema)
        if found is None:
            return None
        closed = self.owner.closed_number()
        return found.where((F.col(_DUE) >= _month(F.lit(closed + 1))) & (F.col(_DAY) > closed)).drop(_RUN)

    def due(self) -> DataFrame | None:
        found = self.waiting()
        return None if found is None else found.where((F.col(_DUE) <= _month(F.lit(self.last))) & (F.col(_DAY) <= self.last)).drop(_DUE)

    def now(self) -> DataFrame:
        return self.events.where(F.col(_DAY).isNull() | (F.col(_DAY) <= self.last))

    def known(self, wanted: list[str]) -> DataFrame:
        """The rows of this run with their totals."""
        rows = self.now().withColumn(_CARRIED, F.lit(False))
        held, due = self.held(), self.due()
        everything = rows
        if held is not None:
            # Only keys of this run; one row per key and run, so a hot key is one row here as well.
            asked = self._keyed(rows.select(*self.keys)).distinct()
            state = held.join(asked, self.keys, "left_semi").withColumns(
                {_AT: self._before(self.owner.closed_number()), _CARRIED: F.lit(True)})
            everything = everything.unionByName(state, allowMissingColumns=True)
        if due is not None:
            everything = everything.unionByName(due.withColumn(_CARRIED, F.lit(True)), allowMissingColumns=True)
        totals = {m: (_MERGED_BY[how], F.col(self.names[m])) for m, (how, _) in self.measures.items()}
        out = totals_before(everything, self.keys, self.order or [_AT], totals, F.col(_AT))
        return out.where(~F.col(_CARRIED)).select(*wanted, *self.measures)

    def added(self) -> DataFrame:
        """Per key, what takes effect in this run's days."""
        columns = [*self.keys, *self.names.values()]
        events = self._keyed(self.now().where(F.col(_DAY).isNotNull())).select(*columns)
        due = self.due()
        return self.summed(events if due is None else events.unionByName(due.select(*columns)), self.keys)

    def left_over(self) -> DataFrame:
        """Events of days after this run's; those of one place are one row."""
        place = [*self.keys, *self.order, _AT, _DAY]
        events = self._keyed(self.events.where(F.col(_DAY) > self.last)).select(*place, *self.names.values())
        return self.summed(events, place).withColumn(_DUE, _month(F.col(_DAY)))

    def summed(self, df: DataFrame, by: list[str]) -> DataFrame:
        """Partial totals added up, in the type that all of them have."""
        kinds = {f.name: f.dataType for f in self.totals_schema}
        return df.groupBy(*by).agg(*(
            _KEPT_AS[how](self.names[m]).cast(kinds[self.names[m]]).alias(self.names[m])
            for m, (how, _) in self.measures.items()))


def _typed(how: str, col: Column) -> Column:
    """What a row adds: counts become ones and zeros, so that all partial totals are merged alike."""
    return F.when(col.isNotNull(), 1).otherwise(0).cast("long") if how == "count" else col


class CarriedHistory:
    """A table of records with their history, below ``base``/``name``, that grows by whole days."""

    def __init__(self, spark: SparkSession, base: str, name: str, commits: CommitLog | None = None, fold_every: int = 32):
        self.spark = spark
        self.base = base.rstrip("/")
        self.name = name
        self.commits = commits or CommitLog(spark, self.base)
        self.fold_every = fold_every

    def totals(self, label: str) -> str:
        return f"{self.name}/totals-{label}"

    def later(self, label: str) -> str:
        return f"{self.name}/later-{label}"

    def _mark(self) -> str | None:
        return next(iter(self.commits.live(f"{self.name}/closed")), None)

    def closed(self) -> date | None:
        """The last day that a run has closed."""
        mark = self._mark()
        return None if mark is None else date.fromisoformat(mark.rpartition("/")[2])

    def closed_number(self) -> int:
        return ((self.closed() or date.min) - EPOCH).days

    def feed(
        self, run: str, batch: DataFrame, at: str, history: Callable[[DataFrame, Callable], DataFrame],
        upto: date | None = None,
    ) -> bool:
        """Publish the rows of whole days with their history; False when the run has been published before.

        ``history(batch, totals)`` calls a history function with ``totals`` in place of its running totals.
        ``upto`` closes days without rows as well; else the last day of the batch is closed. An empty batch
        without it closes nothing. Rows whose ``at`` is null, or not after the last closed day, are refused.
        """
        key = f"{self.name}:{run}"
        if self.commits.published(key):
            return False
        day = F.to_date(F.col(at))
        span = batch.agg(F.min(day).alias("low"), F.max(day).alias("high"), F.count_if(day.isNull()).alias("undated")).first()
        closed, mark = self.closed(), self._mark()
        last = upto or span["high"]
        if span["undated"]:
            raise OutOfOrder(f"{span['undated']} rows without a day")
        if span["low"] is not None and (span["high"] > last or (closed is not None and span["low"] <= closed)):
            raise OutOfOrder(f"rows from {span['low']} to {span['high']}, but days up to {closed} are closed and the run ends at {last}")
        if last is None or (closed is not None and last <= closed):
            self.commits.publish(key)
            return True
        steps: list[_Step] = []

        def totals(df, keys, order, measures, bucket, overall=None):
            if overall:
                raise ValueError("totals over whole keys are not known before the last day")
            step = _Step(self, f"{len(steps)}-{'-'.join(keys)}", df, keys, order, measures, bucket, (last - EPOCH).days)
            steps.append(step)
            return step.known(df.columns)

        folder = f"{_RUN}={folder_value(run)}"
        adds, removes = [f"{self.name}/rows/{folder}", f"{self.name}/closed/{last}"], [] if mark is None else [mark]
        history(batch, totals).write.mode("overwrite").parquet(f"{self.base}/{adds[0]}")
        for step in steps:
            added, left, old = step.added(), step.left_over(), self.commits.live(self.totals(step.label))
            if old and len(old) + 1 >= self.fold_every:
                added = step.summed(added.unionByName(step.held()), step.keys)
                waiting = step.waiting()
                if waiting is not None:
                    left = left.unionByName(waiting.where(F.col(_DAY) > step.last))
                removes += old + self.commits.live(self.later(step.label))
            adds += [f"{self.totals(step.label)}/{folder}", f"{self.later(step.label)}/{folder}"]
            added.write.mode("overwrite").parquet(f"{self.base}/{adds[-2]}")
            left.write.mode("overwrite").partitionBy(_DUE).parquet(f"{self.base}/{adds[-1]}")
        self.commits.publish(key, adds, removes)
        return True

    def read(self, schema: T.StructType | None = None) -> DataFrame | None:
        """All published rows, with the ``run`` that brought them; None before the first."""
        return self.commits.read(f"{self.name}/rows", schema)
