"""Structured Streaming over discovery events: every stage is a transformation of a stream plus a keyed sink."""

from __future__ import annotations

import sys
import time
from collections import defaultdict
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from ..operators import predicates
from ..operators.events import project_news as merge_news
from .keyed import BUCKETS, KeyedTable, into_table

EVENT = "event_id string, accession string, cik string, company string, form string, filing_date string, observed_at timestamp"


def read_events(spark: SparkSession, path: str, *, per_trigger: int | None = None) -> DataFrame:
    """Raw JSON lines as a stream (column value); a message topic gives the same column."""
    reader = spark.readStream.format("text")
    return (reader.option("maxFilesPerTrigger", per_trigger) if per_trigger else reader).load(path)


def split_poison(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events, dead letters): lines that are no valid event, or whose date is none, are set apart."""
    parsed = raw.select("value", F.from_json("value", EVENT).alias("e")).withColumn("filed", F.try_to_date("e.filing_date", "yyyy-MM-dd"))
    fine = F.col("e.accession").isNotNull() & F.col("filed").isNotNull()
    events = parsed.where(fine).select("e.*", "filed").withColumn("filing_date", F.col("filed")).drop("filed")
    return events, parsed.where(~fine).select("value")


def dedupe(events: DataFrame, *, window: str = "24 hours") -> DataFrame:
    """One event per id within the window; state older than the watermark is dropped."""
    return events.withWatermark("observed_at", window).dropDuplicatesWithinWatermark(["event_id"])


def select(events: DataFrame, members: DataFrame, forms: list[str], set_name: str) -> DataFrame:
    """Stream-static join with the constituent set; column selected tells the two sinks apart."""
    return predicates.selection(predicates.pipeline_boundary(events), members, forms, set_name)


def ownership_branch(events: DataFrame) -> DataFrame:
    rows = events.withColumn("__o", predicates.ownership_family(F.col("form"))).where("__o.supported")
    return rows.withColumn("family", F.col("__o.family")).drop("__o")


def on_demand(selected: DataFrame, requests: DataFrame) -> DataFrame:
    return selected.unionByName(requests, allowMissingColumns=True)


def observe(events: DataFrame, stage: str, **counts: Column) -> DataFrame:
    """Counts per micro-batch for a StageCounters listener: scanned, and the rows of which each named condition holds."""
    if not counts and "selected" in events.columns:
        counts = {"selected": F.col("selected"), "skipped": ~F.col("selected")}
    return events.observe(stage, F.count(F.lit(1)).alias("scanned"), *[F.count_if(c).alias(n) for n, c in counts.items()])


class StageCounters(StreamingQueryListener):
    """Totals of observe() by stage over all batches of all queries, with the seconds that their batches took."""

    def __init__(self):
        self.totals: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
        self.seconds: dict[str, float] = defaultdict(float)
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        for stage, row in event.progress.observedMetrics.items():
            for name, n in row.asDict().items():
                self.totals[stage][name] += n or 0
            self.seconds[stage] += event.progress.batchDuration / 1000

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def rate(self, stage: str) -> float:
        """Rows scanned a second."""
        return self.totals[stage]["scanned"] / self.seconds[stage] if self.seconds[stage] else 0.0

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the end of a query has been heard, behind all its progress."""
        until = time.time() + seconds
        while str(query.runId) not in self.ended:
            if time.time() > until:
                raise TimeoutError("the query's end was not heard")
            time.sleep(0.05)


def drain(stream: DataFrame, path: str, checkpoint: str, *, mode: str = "append") -> StreamingQuery:
    """Process the backlog into Parquet, then stop. A new checkpoint folder replays from the start."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _first_wins(before: DataFrame, batch: DataFrame) -> DataFrame:
    first = batch.dropDuplicates(["accession"])
    return before.unionByName(first.join(before.select("accession"), "accession", "left_anti").select(*before.columns))


def accession_once(stream: DataFrame, path: str, checkpoint: str, *, buckets: int = BUCKETS) -> tuple[StreamingQuery, KeyedTable]:
    """Keep each accession once for good: a batch touches the buckets of its accessions only."""
    table = KeyedTable(stream.sparkSession, path, stream.schema, ["accession"], buckets=buckets)
    return into_table(stream, table, checkpoint, _first_wins), table


def project_news(stream: DataFrame, path: str, checkpoint: str, *, buckets: int = BUCKETS) -> tuple[StreamingQuery, KeyedTable]:
    """Keep the latest state of every accession; a new checkpoint replays from the start into the same or another path."""
    table = KeyedTable(stream.sparkSession, path, stream.schema, ["accession"], buckets=buckets)
    return into_table(stream, table, checkpoint, lambda before, batch: merge_news(before, batch.select(*before.columns))), table


def retry(outcomes: DataFrame, *, limit: int = 5, delay_seconds: int = 60) -> DataFrame:
    """Attempts per accession: failed ones come out with their next time, or as exhausted at the limit; a success resets.

    outcomes: accession, ok, at (epoch seconds). State is one counter per accession with open failures.
    """
    import pandas as pd

    def step(key, batches, state):
        attempts = state.get[0] if state.exists else 0
        rows = []
        for ok, at in pd.concat(list(batches)).sort_values("at")[["ok", "at"]].itertuples(index=False):
            attempts = 0 if ok else attempts + 1
            status = "resolved" if ok else "exhausted" if attempts >= limit else "retry"
            rows.append((key[0], attempts, status, None if status != "retry" else int(at) + delay_seconds))
        if attempts:
            state.update((attempts,))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(rows, columns=["accession", "attempts", "status", "next_at"]).astype({"next_at": "Int64"})

    return outcomes.groupBy("accession").applyInPandasWithState(step, "accession string, attempts long, status string, next_at long", "attempts long", "append", "NoTimeout")


class Retries(StatefulProcessor):
    """Attempts of one accession and the timer that emits its next one."""

    def __init__(self, limit: int, delay_seconds: int):
        self.limit, self.delay = limit, delay_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.attempts = handle.getValueState("attempts", "attempts long")

    def _rows(self, key, found):
        import pandas as pd

        return pd.DataFrame([(key[0], *r) for r in found], columns=["accession", "attempts", "status"])

    def _disarm(self) -> None:
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)

    def handleInputRows(self, key, rows, timerValues):
        import pandas as pd

        n, found = self.attempts.get()[0] if self.attempts.exists() else 0, []
        for ok in pd.concat(list(rows)).sort_values("at")["ok"].tolist():
            if not ok:
                n += 1
                if n >= self.limit:
                    found.append((n, "exhausted"))
            elif n:
                found.append((n, "resolved"))
                n = 0
        self._disarm()
        if n:
            self.attempts.update((n,))
            if n < self.limit:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + 1000 * self.delay)
        elif self.attempts.exists():
            self.attempts.clear()
        yield self._rows(key, found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield self._rows(key, [(self.attempts.get()[0], "retry")])

    def close(self) -> None: ...


def retry_after(outcomes: DataFrame, *, limit: int = 5, delay_seconds: int = 60) -> DataFrame:
    """Retries as rows that come out once their delay is over; failures from the limit on come out at once as exhausted, a
    success after failures as resolved. A further outcome in the meantime disarms the timer.

    outcomes: accession, ok, at. State is a counter and at most one timer per accession with open failures; it needs the
    RocksDB state store (timed_state sets it).
    """
    return outcomes.groupBy("accession").transformWithStateInPandas(Retries(limit, delay_seconds), "accession string, attempts long, status string", "append", "ProcessingTime")


@contextmanager
def timed_state(spark: SparkSession):
    """Queries started inside keep state in RocksDB."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the repository
