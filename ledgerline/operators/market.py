"""Prices, corporate actions and the state of their synchronization."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KEY = ["security"]
PRIORITY = ["bootstrap", "repair", "reconcile", "incremental"]


def upsert(current: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """Rows by key, fresh ones in place of current ones; fresh is unique by key."""
    return current.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh)


def apply_prices(current: DataFrame, batch: DataFrame) -> DataFrame:
    return upsert(current, batch, ["security", "date"])


def changed_actions(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Batch actions with changed: new, or different in any value."""
    values = ["date", "action_type", "amount", "numerator", "denominator"]
    old = current.select("security", "source_id", F.struct(*values).alias("__old"))
    rows = batch.join(old, ["security", "source_id"], "left")
    return rows.withColumn("changed", F.col("__old").isNull() | ~F.col("__old").eqNullSafe(F.struct(*values))).drop("__old")


def replace_actions(current: DataFrame, batch: DataFrame, now: str) -> DataFrame:
    """Actions after a bootstrap or reconcile run: the batch in place of all actions of its securities, reconciled now."""
    kept = current.join(batch.select("security").distinct(), "security", "left_anti")
    return kept.unionByName(batch.withColumn("reconciled_at", F.lit(now).cast(current.schema["reconciled_at"].dataType)).select(*current.columns))


def apply_actions(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Actions after an incremental or repair batch; a changed action loses its reconciled_at."""
    marked = changed_actions(current, batch)
    kept = current.select("security", "source_id", F.col("reconciled_at").alias("__at"))
    fresh = marked.join(kept, ["security", "source_id"], "left").withColumn("reconciled_at", F.when(~F.col("changed"), F.col("__at")))
    return upsert(current, fresh.select(*current.columns), ["security", "source_id"])


def advance_state(current: DataFrame, results: DataFrame) -> DataFrame:
    """Watermarks widened by results, reconciliation kept if either asks, failures reset."""
    cols = ["security", "covered_from", "covered_through", "observed_from", "observed_through", "reconcile"]
    both = current.select(*cols).unionByName(results.select(*cols))
    return both.groupBy("security").agg(
        F.min("covered_from").alias("covered_from"), F.max("covered_through").alias("covered_through"),
        F.min("observed_from").alias("observed_from"), F.max("observed_through").alias("observed_through"), F.coalesce(F.bool_or("reconcile"), F.lit(False)).alias("reconcile"), F.lit(0).alias("failures"),
    )


def pending_repair(repairs: DataFrame) -> DataFrame:
    """Earliest open repair of each security."""
    best = repairs.where("completed_at is null").groupBy("security").agg(F.min(F.struct("from_date", "through")).alias("r"))
    return best.select("security", "r.from_date", "r.through")


def work(securities: DataFrame, prices: DataFrame, state: DataFrame, repairs: DataFrame, from_date: str, through: str) -> DataFrame:
    """What each security needs next: bootstrap, reconcile, repair, incremental or none, with its span."""
    priced = prices.groupBy("security").agg(F.lit(True).alias("priced"))
    fix = pending_repair(repairs).select("security", F.col("from_date").alias("fix_from"), F.col("through").alias("fix_through"))
    rows = securities.select("security").join(priced, "security", "left").join(state, "security", "left").join(fix, "security", "left")
    lo, hi = F.lit(from_date).cast("date"), F.lit(through).cast("date")
    restart = F.coalesce("observed_through", "covered_through")
    kind = (
        F.when(F.col("priced").isNull() | ~F.coalesce("bootstrapped", F.lit(False)) | F.col("covered_from").isNull() | (F.col("covered_from") > lo), "bootstrap")
        .when(F.col("reconcile"), "reconcile").when(F.col("fix_from").isNotNull(), "repair").when(restart < hi, "incremental").otherwise("none")
    )
    rows = rows.withColumn("kind", kind)
    start = F.when(F.col("kind").isin("bootstrap", "reconcile"), lo).when(F.col("kind") == "repair", F.col("fix_from")).when(F.col("kind") == "incremental", restart)
    end = F.when(F.col("kind") == "repair", F.col("fix_through")).when(F.col("kind") != "none", hi)
    return rows.select("security", "kind", start.alias("from_date"), end.alias("through"))


def work_queue(rows: DataFrame, *, max_items: int | None = None) -> DataFrame:
    at = F.array_position(F.array(*map(F.lit, PRIORITY)), F.col("kind"))
    out = rows.where("kind != 'none'").orderBy(at, "from_date", "security")
    return out.limit(max_items) if max_items else out


def contained_repairs(repairs: DataFrame, ranges: DataFrame) -> DataFrame:
    """Open repairs that a finished range of their security contains."""
    r = ranges.select("security", F.col("from_date").alias("__lo"), F.col("through").alias("__hi"))
    return repairs.where("completed_at is null").join(r, (repairs["security"] == r["security"]) & (F.col("from_date") >= F.col("__lo")) & (F.col("through") <= F.col("__hi")), "left_semi")


def complete_repairs(repairs: DataFrame, finished: DataFrame, now: str) -> DataFrame:
    """Repairs after finished work (security, kind, from_date, through): a repair closes its exact range, a bootstrap or
    reconcile run every open range inside its own."""
    done = finished.select("security", F.col("kind").alias("__kind"), F.col("from_date").alias("__lo"), F.col("through").alias("__hi"))
    exact = (F.col("__lo") == F.col("from_date")) & (F.col("__hi") == F.col("through"))
    inside = (F.col("from_date") >= F.col("__lo")) & (F.col("through") <= F.col("__hi"))
    fits = F.when(F.col("__kind") == "repair", exact).otherwise(inside & F.col("__kind").isin("bootstrap", "reconcile"))
    spans = done.groupBy("security").agg(F.collect_set(F.struct("__kind", "__lo", "__hi")).alias("__done"))  # a few runs a security
    closed = repairs.join(spans, "security", "left").withColumn("__x", F.explode_outer("__done")).withColumns({c: F.col(f"__x.{c}") for c in ("__kind", "__lo", "__hi")})
    closed = closed.where("completed_at is null").where(fits).select("security", "from_date", "through").distinct().withColumn("__closed", F.lit(True))
    out = repairs.join(closed, ["security", "from_date", "through"], "left")
    at = F.when(F.col("completed_at").isNull() & F.col("__closed"), F.lit(now).cast(repairs.schema["completed_at"].dataType)).otherwise(F.col("completed_at"))
    return out.withColumn("completed_at", at).select(*repairs.columns)


def requeue_repairs(repairs: DataFrame, ranges: DataFrame) -> DataFrame:
    """Queue ranges (security, from_date, through): known ones open again, others are added."""
    keys = ["security", "from_date", "through"]
    asked = ranges.select(*keys).distinct()
    known = repairs.join(asked.withColumn("__asked", F.lit(True)), keys, "left")
    known = known.withColumn("completed_at", F.when(F.col("__asked").isNull(), F.col("completed_at"))).select(*repairs.columns)
    fresh = asked.join(repairs.select(*keys), keys, "left_anti")
    return known.unionByName(fresh, allowMissingColumns=True)


def unordered_dates(prices: DataFrame) -> DataFrame:
    before = F.lag("date").over(Window.partitionBy("security").orderBy("position"))
    return prices.withColumn("before", before).where(F.col("before") >= F.col("date"))


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg((F.count("*") - 1).alias("extra")).where("extra > 0")


def chosen_batches(batches: DataFrame, start: str) -> DataFrame:
    """Batches that recovery applies, with their order and what each symbol's chain covers.

    batches: symbol, kind (snapshot, incremental, repair), batch, from_date, through. The base is the snapshot that starts by
    `start` and reaches furthest. From there each step takes the one increment that reaches furthest among those that start at
    most a day after what is covered. Repairs that lie inside the covered span, from the base's own start on, come last.
    One fold over a symbol's increments in order of their starts finds the chain: a candidate is taken once a batch starts
    beyond its reach's predecessor, so no step searches anew. Of equal reach the earliest start counts. Returns symbol, batch,
    apply_order, covered_from, covered_through; symbols without a base have no rows.
    """
    lo = F.lit(start).cast("date")
    first = F.min_by(F.struct("batch", "from_date", "through"), F.struct(-F.unix_date("through"), "from_date", "batch"))
    base = batches.where((F.col("kind") == "snapshot") & (F.col("from_date") <= lo)).groupBy("symbol").agg(first.alias("base"))
    steps = batches.where("kind = 'incremental'").groupBy("symbol").agg(F.sort_array(F.collect_list(F.struct("from_date", "batch", "through"))).alias("steps"))
    kinds = {f.name: f.dataType.simpleString() for f in batches.schema.fields}
    taken = f"array<struct<from_date:{kinds['from_date']},batch:{kinds['batch']},through:{kinds['through']}>>"
    none = F.lit(None)
    begin = F.struct(F.col("base.through").alias("covered"), none.cast(taken[6:-1]).alias("best"), F.array().cast(taken).alias("chain"))

    def reached(a: Column) -> Column:
        return F.coalesce(a["best"]["through"], a["covered"])

    def settled(a: Column) -> Column:
        """The candidate becomes part of the chain."""
        return F.struct(reached(a).alias("covered"), none.cast(taken[6:-1]).alias("best"), F.when(a["best"].isNotNull(), F.concat(a["chain"], F.array(a["best"]))).otherwise(a["chain"]).alias("chain"))

    def considered(a: Column, x: Column) -> Column:
        better = (x["from_date"] <= F.date_add(a["covered"], 1)) & (x["through"] > reached(a))
        return F.struct(a["covered"].alias("covered"), F.when(better, x).otherwise(a["best"]).alias("best"), a["chain"].alias("chain"))

    def step(a: Column, x: Column) -> Column:
        return F.when(x["from_date"] > F.date_add(a["covered"], 1), considered(settled(a), x)).otherwise(considered(a, x))

    found = base.join(steps, "symbol", "left").withColumn("end", F.aggregate(F.coalesce("steps", F.array().cast(taken)), begin, step, settled))
    span = found.select("symbol", "base", F.col("end.chain").alias("chain"), F.col("base.from_date").alias("covered_from"), F.col("end.covered").alias("covered_through"))

    def order(stage: int, *by: str) -> Column:
        return F.struct(F.lit(stage).alias("stage"), *[F.col(c).alias(n) for c, n in zip(by, ("first", "second", "batch"), strict=True)]).alias("apply_order")

    bases = span.select("symbol", "base.*", "covered_from", "covered_through").select("symbol", "batch", order(0, "from_date", "through", "batch"), "covered_from", "covered_through")
    chained = span.select("symbol", F.explode("chain").alias("x"), "covered_from", "covered_through").select("symbol", "x.*", "covered_from", "covered_through")
    chained = chained.select("symbol", "batch", order(1, "through", "from_date", "batch"), "covered_from", "covered_through")
    fixes = batches.where("kind = 'repair'").join(span.drop("base", "chain"), "symbol").where("from_date >= covered_from AND through <= covered_through")
    fixes = fixes.select("symbol", "batch", order(2, "from_date", "through", "batch"), "covered_from", "covered_through")
    return bases.unionByName(chained).unionByName(fixes)


def recover_batches(batches: DataFrame, start: str) -> DataFrame:
    """symbol, from_date, through, batches: the span that landed batches cover from `start` on, and how many are applied."""
    return recovered_spans(chosen_batches(batches, start))


def recovered_spans(chosen: DataFrame) -> DataFrame:
    """recover_batches of batches that are chosen already."""
    return chosen.groupBy("symbol").agg(F.first("covered_from").alias("from_date"), F.first("covered_through").alias("through"), F.count("*").alias("batches"))


def recover_values(rows: DataFrame, batches: DataFrame, start: str, *, key: str = "date", values: list[str]) -> DataFrame:
    """The values of every key (a price's date, an action's source_id) that recovery gives: of the applied batches the last wins.

    rows: symbol, batch, key and values. A maximum by order, combined before the shuffle.
    """
    return recovered_values(rows, chosen_batches(batches, start), key=key, values=values)


def recovered_values(rows: DataFrame, chosen: DataFrame, *, key: str = "date", values: list[str]) -> DataFrame:
    """recover_values of batches that are chosen already."""
    kept = rows.join(chosen.select("symbol", "batch", "apply_order"), ["symbol", "batch"])
    return kept.groupBy("symbol", key).agg(F.max_by(F.struct(*values, "batch"), "apply_order").alias("v")).select("symbol", key, *[f"v.{c}" for c in (*values, "batch")])


def price_bounds(prices: DataFrame) -> DataFrame:
    return prices.groupBy("security").agg(F.min("date").alias("first"), F.max("date").alias("last"))


def price_coverage(prices: DataFrame, *, by_symbol: bool = False) -> DataFrame:
    keys = ["security"] if by_symbol else []
    return prices.groupBy(*keys).agg(F.min("date").alias("first"), F.max("date").alias("last"), F.count("*").alias("prices"), F.count_distinct("security").alias("securities"))


def overview(securities: DataFrame, prices: DataFrame, actions: DataFrame, state: DataFrame) -> DataFrame:
    """One row of totals with a status label; each total is one aggregate over its table."""
    one = securities.agg(F.count("*").alias("securities"))
    one = one.crossJoin(prices.agg(F.count_distinct("security").alias("priced"), F.count("*").alias("prices"), F.count_if(F.col("open").isNull()).alias("missing_opens")))
    one = one.crossJoin(actions.agg(F.count("*").alias("actions")))
    one = one.crossJoin(state.agg(F.count_if(F.col("covered_from").isNotNull()).alias("known"), F.count_if("reconcile").alias("reconciles"), F.count_if(F.col("failures") > 0).alias("retries")))
    label = F.when(F.col("retries") > 0, "ATTENTION").when(F.col("reconciles") > 0, "RECONCILING").when(F.col("priced") < F.col("securities"), "LOADING").when(F.col("known") < F.col("securities"), "BACKFILL").otherwise("READY")
    return one.withColumn("status", label)


def metric_lines(one_row: DataFrame) -> DataFrame:
    """metric, value lines of a one-row table."""
    return one_row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value")) for c in one_row.columns])).alias("x")).select("x.metric", "x.value")


def fx_pivot(observations: DataFrame) -> DataFrame:
    """One CSV-ready row per observation: sorted key columns, value with as many decimals as tell it from others, no exponent."""
    text = F.col("value").cast("string")
    plain = F.when(text.contains("E"), F.coalesce(text.try_cast("decimal(38,18)").cast("string"), text)).otherwise(text)
    return observations.select("currency", "denominator", "time", F.regexp_replace(plain, r"(\.\d*?)0+$", "$1").alias("v")).select("currency", "denominator", "time", F.regexp_replace("v", r"\.$", "").alias("value")).orderBy("currency", "denominator", "time")
