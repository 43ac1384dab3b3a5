"""One pass of price synchronization: queued work is answered, judged item by item, and applied to the stored tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as fn
from . import market, predicates

#: What tells an item: its security, and whether retained batches or the provider answered it.
ITEM = ["security", "recovered"]
#: Kinds of work that replace all actions of their security.
WHOLE = ("bootstrap", "reconcile")
#: Longest error that the state keeps.
ERROR_LENGTH = 1000


class Market(NamedTuple):
    """The stored tables. prices: security, date, open, close, adjusted_close; actions: with source_id and reconciled_at;
    state: a row a security, with next_attempt and last_error; repairs: security, from_date, through, completed_at."""

    prices: DataFrame
    actions: DataFrame
    state: DataFrame
    repairs: DataFrame


class Answers(NamedTuple):
    """Rows that answer queued work: prices and actions with recovered, and the errors (security, error) of failed requests."""

    prices: DataFrame
    actions: DataFrame
    errors: DataFrame


def ready(queue: DataFrame, state: DataFrame, now: str) -> DataFrame:
    """Queued items with their failures so far and whether a retry still has to wait (deferred)."""
    known = state.select("security", "failures", (F.col("next_attempt") > F.lit(now).cast("timestamp")).alias("deferred"))
    rows = queue.where("kind != 'none'").join(known, "security", "left")
    return rows.withColumns({"failures": F.coalesce("failures", F.lit(0)), "deferred": F.coalesce("deferred", F.lit(False))})


def retained_answers(queue: DataFrame, chosen: DataFrame, prices: DataFrame, actions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(items, prices, actions) that retained batches give for queued bootstraps: spans and the last values of each key.

    chosen: market.chosen_batches from the start of the queue on.
    """
    asked = queue.where("kind = 'bootstrap' AND NOT deferred").select(F.col("security").alias("symbol"), "failures", "deferred")
    mine = chosen.join(asked.select("symbol"), "symbol", "left_semi")
    spans = market.recovered_spans(mine).join(asked, "symbol")
    items = spans.select(F.col("symbol").alias("security"), F.lit("bootstrap").alias("kind"), "from_date", "through", "failures", "deferred")

    def last(rows: DataFrame, key: str, values: list[str]) -> DataFrame:
        return market.recovered_values(rows, mine, key=key, values=values).drop("batch").withColumnRenamed("symbol", "security")

    return items, last(prices, "date", ["open", "close", "adjusted_close"]), last(actions, "source_id", ["date", "action_type", "amount", "numerator", "denominator"])


def judged_items(items: DataFrame, answers: Answers) -> DataFrame:
    """One row per security: the item that counts, its outcome (completed, recovered, failed, deferred), reason, numbers of
    rows and the span of its prices.

    One bad row fails its whole item; a deferred item was not asked for, so it has no rows. Retained batches count where they are whole; else the provider's answer does. The
    result is read by every table of `applied`, so store it first.
    """
    span = items.where("NOT deferred").select(*ITEM, F.col("from_date").alias("__lo"), F.col("through").alias("__hi"))
    bounds = (F.col("__lo"), F.col("__hi"))
    blank = F.coalesce("source_id", F.lit("")) == ""
    p = answers.prices.join(span, ITEM).select(*ITEM, "date", predicates.price_fault(*bounds).alias("fault"), F.lit(1).alias("p"))
    a = answers.actions.join(span, ITEM).select(*ITEM, F.lit(None).cast("date").alias("date"), F.when(blank, "no source id").otherwise(predicates.action_fault(*bounds)).alias("fault"), F.lit(0).alias("p"))
    sums = p.unionByName(a).groupBy(*ITEM).agg(F.min("fault").alias("fault"), F.sum("p").alias("prices"), F.sum(1 - F.col("p")).alias("actions"), F.min("date").alias("first"), F.max("date").alias("last"))
    errors = answers.errors.groupBy("security").agg(F.min("error").alias("error")).withColumn("recovered", F.lit(False))
    rows = items.join(sums, ITEM, "left").join(errors, ITEM, "left").na.fill(0, ["prices", "actions"])
    reason = F.when(~F.col("deferred"), F.coalesce("error", "fault"))
    rows = rows.withColumn("reason", reason).drop("error", "fault").where("NOT recovered OR reason IS NULL")
    rest = [c for c in rows.columns if c != "security"]
    best = rows.groupBy("security").agg(F.max_by(F.struct(*rest), "recovered").alias("i")).select("security", "i.*")
    outcome = F.when(F.col("deferred"), "deferred").when(F.col("reason").isNotNull(), "failed").when(F.col("recovered"), "recovered").otherwise("completed")
    return best.withColumn("outcome", outcome)


def applied(stored: Market, judged: DataFrame, answers: Answers, now: str) -> Market:
    """The tables after a pass. Sound items bring their prices and actions, widen the state and close repairs; failed ones
    are counted and wait longer each time; deferred ones leave all as it is."""
    done = judged.where("outcome in ('completed', 'recovered')")
    whole = F.col("kind").isin(*WHOLE)
    item = done.select(*ITEM, whole.alias("__whole"))
    prices = market.apply_prices(stored.prices, answers.prices.join(item, ITEM, "left_semi").select(*stored.prices.columns))

    kept = stored.actions.join(done.where(whole), "security", "left_anti")
    fresh = answers.actions.join(item, ITEM)
    parts = fresh.where("NOT __whole").select(*[c for c in stored.actions.columns if c != "reconciled_at"])
    full = fresh.where("__whole").withColumn("reconciled_at", F.lit(now).cast(stored.actions.schema["reconciled_at"].dataType)).select(*stored.actions.columns)
    actions = market.apply_actions(kept, parts).unionByName(full)

    changed = market.changed_actions(kept, parts).where("changed").select("security").distinct().withColumn("__changed", F.lit(True))
    state = _advanced(stored.state, judged.where("outcome != 'deferred'").join(changed, "security", "left"), now)
    return Market(prices, actions, state, market.complete_repairs(stored.repairs, done, now))


def _advanced(state: DataFrame, judged: DataFrame, now: str) -> DataFrame:
    """State after judged items: one join by security, in which an item either widens the watermarks or counts as a failure."""
    i = judged.select("security", F.struct("kind", "from_date", "through", "first", "last", "reason", F.coalesce("__changed", F.lit(False)).alias("changed")).alias("i"))
    whole = F.col("i.kind").isin(*WHOLE)
    good, bad = F.col("i").isNotNull() & F.col("i.reason").isNull(), F.col("i.reason").isNotNull()
    failures = F.coalesce("failures", F.lit(0))
    wait = F.make_interval(mins=fn.retry_delay_minutes(failures + 1))
    old = F.coalesce("reconcile", F.lit(False))
    new = {
        "bootstrapped": good | F.coalesce("bootstrapped", F.lit(False)),
        "covered_from": F.when(good & whole, F.least("covered_from", "i.from_date")).otherwise(F.col("covered_from")),
        "covered_through": F.when(good, F.greatest("covered_through", "i.through")).otherwise(F.col("covered_through")),
        "observed_from": F.when(good, F.least("observed_from", "i.first")).otherwise(F.col("observed_from")),
        "observed_through": F.when(good, F.greatest("observed_through", "i.last")).otherwise(F.col("observed_through")),
        "reconcile": F.when(good & (F.col("i.kind") == "reconcile"), False).when(good & ~whole, old | F.col("i.changed")).otherwise(old),
        "failures": F.when(good, 0).when(bad, failures + 1).otherwise(failures),
        "next_attempt": F.when(bad, F.lit(now).cast("timestamp") + wait).when(~good, F.col("next_attempt")),
        "last_error": F.when(bad, F.left("i.reason", F.lit(ERROR_LENGTH))).when(~good, F.col("last_error")),
    }
    return state.join(i, "security", "full").withColumns(new).select(*state.columns)


def totals(judged: DataFrame) -> DataFrame:
    """One row: items by outcome, rows that sound items brought, and the earliest span start of the deferred ones."""
    sound = F.col("outcome").isin("completed", "recovered")
    return judged.agg(
        F.count("*").alias("pending"), F.count_if(sound).alias("completed"), *[F.count_if(F.col("outcome") == o).alias(o) for o in ("recovered", "failed", "deferred")],
        *[F.coalesce(F.sum(F.when(sound, F.col(c))), F.lit(0)).alias(c) for c in ("prices", "actions")],
    )
