"""Queries of a price pass: work, retained batches and a provider's answers over the market tables, and SQL of each result."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import composites, market, sync
from . import adapters
from .more import _APPLIED, _LAST
from .queries import ORACLES, QUERIES
from .round_trips import _folder

START, THROUGH, NOW = "2024-01-10", "2024-01-31", "2024-02-01 00:00:00"
_TABLES = "securities prices actions state repairs batches batch_prices batch_actions"

#: Stored tables and answers, as SELECTs that Spark and DuckDB both run. Stored are the prices of the first half month; some
#: securities wait for a retry, some have all repairs closed. The provider answers the queued span of most securities, all days
#: of every fourth, other amounts for every fifth, an unusable price for every ninth, and an error for every seventh.
STORED = {
    "s_prices": "SELECT security, date, open, close, adjusted_close FROM {prices} WHERE date < DATE '2024-01-15'",
    "s_actions": "SELECT security, source_id, date, action_type, amount, numerator, denominator, reconciled_at FROM {actions} WHERE date < DATE '2024-01-20'",
    "s_state": "SELECT security, bootstrapped, covered_from, covered_through, observed_from, observed_through, reconcile, failures, CASE WHEN CAST(security AS INT) % 13 = 1 THEN TIMESTAMP '2024-03-01 00:00:00' END AS next_attempt, CASE WHEN failures > 0 THEN 'earlier error' END AS last_error FROM {state}",
    "s_repairs": "SELECT security, from_date, through, CASE WHEN CAST(security AS INT) % 3 = 0 THEN through ELSE completed_at END AS completed_at, event_id FROM {repairs}",
    "errors": "SELECT security, 'no chart' AS error FROM {securities} WHERE CAST(security AS INT) % 7 = 2",
    "r_prices": "SELECT symbol, batch, date, max(close) AS close, max(close) AS adjusted_close, CAST(NULL AS DOUBLE) AS open FROM {batch_prices} GROUP BY symbol, batch, date",
    "r_actions": "SELECT symbol, batch, source_id, date, action_type, CASE action_type WHEN 'dividend' THEN amount END AS amount, CASE action_type WHEN 'split' THEN 2.0E0 END AS numerator, CASE action_type WHEN 'split' THEN 1.0E0 END AS denominator FROM {batch_actions}",
}
#: They read the queue: security, kind, from_date, through.
TOLD = {
    "t_prices": "SELECT p.security, date, open, CASE WHEN CAST(p.security AS INT) % 9 = 4 THEN -close ELSE close + 1 END AS close, adjusted_close FROM {prices} p JOIN {queue} q ON q.security = p.security WHERE (date BETWEEN q.from_date AND q.through) OR CAST(p.security AS INT) % 4 = 1",
    "t_actions": "SELECT a.security, source_id, date, action_type, CASE WHEN CAST(a.security AS INT) % 5 = 0 THEN amount * 2 ELSE amount END AS amount, numerator, denominator FROM {actions} a JOIN {queue} q ON q.security = a.security WHERE date BETWEEN q.from_date AND q.through",
}
_SPANNED = f"""queue AS (SELECT n.security, kind, CASE kind WHEN 'repair' THEN rf WHEN 'incremental' THEN restart ELSE DATE '{START}' END AS from_date, CASE kind WHEN 'repair' THEN rt ELSE DATE '{THROUGH}' END AS through, failures, deferred FROM (
SELECT s.security, coalesce(failures, 0) AS failures, coalesce(next_attempt > TIMESTAMP '{NOW}', false) AS deferred, coalesce(observed_through, covered_through) AS restart, rf, rt, CASE WHEN p.security IS NULL OR NOT coalesce(bootstrapped, false) OR covered_from IS NULL OR covered_from > DATE '{START}' THEN 'bootstrap' WHEN reconcile THEN 'reconcile'
WHEN rf IS NOT NULL THEN 'repair' WHEN coalesce(observed_through, covered_through) < DATE '{THROUGH}' THEN 'incremental' ELSE 'none' END AS kind FROM securities s LEFT JOIN (SELECT DISTINCT security FROM s_prices) p ON p.security = s.security LEFT JOIN s_state t ON t.security = s.security
LEFT JOIN (SELECT security, from_date AS rf, through AS rt FROM s_repairs WHERE completed_at IS NULL QUALIFY row_number() OVER (PARTITION BY security ORDER BY from_date, through) = 1) r ON r.security = s.security) n WHERE kind <> 'none')"""
_JUDGED = f""", items AS (SELECT security, kind, from_date, through, failures, deferred, false AS recovered FROM queue UNION ALL SELECT q.security, kind, s.from_date, s.through, failures, deferred, true FROM queue q JOIN span s ON s.symbol = q.security WHERE kind = 'bootstrap' AND NOT deferred),
a_prices AS (SELECT security, date, open, close, adjusted_close, false AS recovered FROM t_prices UNION ALL SELECT r.symbol, r.date, r.open, r.close, r.adjusted_close, true FROM r_prices r JOIN applied a ON a.symbol = r.symbol AND a.batch = r.batch {_LAST.format('r.date')}),
a_actions AS (SELECT security, source_id, date, action_type, amount, numerator, denominator, false AS recovered FROM t_actions UNION ALL SELECT r.symbol, r.source_id, r.date, r.action_type, r.amount, r.numerator, r.denominator, true FROM r_actions r JOIN applied a ON a.symbol = r.symbol AND a.batch = r.batch {_LAST.format('r.source_id')}),
faults AS (SELECT i.security, i.recovered, CASE WHEN date < from_date OR date > through THEN 'date outside range' WHEN close IS NULL OR close <= 0 THEN 'invalid close' WHEN adjusted_close IS NULL OR adjusted_close <= 0 THEN 'invalid adjusted close' WHEN open <= 0 THEN 'invalid open' END AS fault, 1 AS p, date FROM items i JOIN a_prices a ON a.security = i.security AND a.recovered = i.recovered AND NOT deferred
UNION ALL SELECT i.security, i.recovered, CASE WHEN date < from_date OR date > through THEN 'date outside range' WHEN action_type = 'dividend' AND (amount IS NULL OR amount <= 0) THEN 'invalid dividend' END, 0, NULL FROM items i JOIN a_actions a ON a.security = i.security AND a.recovered = i.recovered AND NOT deferred),
sums AS (SELECT security, recovered, min(fault) AS fault, sum(p) AS prices, count(*) - sum(p) AS actions, min(date) AS lo, max(date) AS hi FROM faults GROUP BY ALL),
rated AS (SELECT i.*, CASE WHEN NOT deferred THEN coalesce(e.error, fault) END AS reason, coalesce(prices, 0) AS prices, coalesce(actions, 0) AS actions, lo, hi FROM items i LEFT JOIN sums s ON s.security = i.security AND s.recovered = i.recovered LEFT JOIN errors e ON e.security = i.security AND NOT i.recovered),
judged AS MATERIALIZED (SELECT *, CASE WHEN deferred THEN 'deferred' WHEN reason IS NOT NULL THEN 'failed' WHEN recovered THEN 'recovered' ELSE 'completed' END AS outcome, kind IN ('bootstrap', 'reconcile') AS whole FROM rated WHERE NOT recovered OR reason IS NULL QUALIFY row_number() OVER (PARTITION BY security ORDER BY recovered DESC) = 1),
done AS (SELECT * FROM judged WHERE outcome IN ('completed', 'recovered')),
fresh AS (SELECT a.*, whole, o.security IS NOT NULL AS known, o.reconciled_at AS held_at, o.security IS NULL OR (o.date, o.action_type, o.amount, o.numerator, o.denominator) IS DISTINCT FROM (a.date, a.action_type, a.amount, a.numerator, a.denominator) AS changed FROM a_actions a JOIN done d ON d.security = a.security AND d.recovered = a.recovered
  LEFT JOIN s_actions o ON o.security = a.security AND o.source_id = a.source_id AND NOT whole)"""
#: A security's retry waits 1, 2, 4 ... up to 64 minutes.
_WAIT = f"TIMESTAMP '{NOW}' + to_minutes(CAST(1 << least(coalesce(t.failures, 0), 6) AS BIGINT))"
_RESULTS = {
    "c16_items": "SELECT security, kind, from_date, through, outcome, reason, CAST(prices AS BIGINT) AS prices, CAST(actions AS BIGINT) AS actions FROM judged",
    "c16_totals": "SELECT count(*) AS pending, count(*) FILTER (outcome IN ('completed', 'recovered')) AS completed, count(*) FILTER (outcome = 'recovered') AS recovered, count(*) FILTER (outcome = 'failed') AS failed, count(*) FILTER (outcome = 'deferred') AS deferred, CAST(coalesce(sum(prices) FILTER (outcome IN ('completed', 'recovered')), 0) AS BIGINT) AS prices, CAST(coalesce(sum(actions) FILTER (outcome IN ('completed', 'recovered')), 0) AS BIGINT) AS actions FROM judged",
    "c16_prices": "SELECT a.security, date, open, close, adjusted_close FROM a_prices a JOIN done d ON d.security = a.security AND d.recovered = a.recovered UNION ALL SELECT * FROM s_prices s WHERE NOT EXISTS (SELECT 1 FROM a_prices a JOIN done d ON d.security = a.security AND d.recovered = a.recovered WHERE a.security = s.security AND a.date = s.date)",
    "c16_actions": f"SELECT security, source_id, date, action_type, amount, numerator, denominator, CASE WHEN whole THEN DATE '{NOW[:10]}' WHEN NOT changed THEN held_at END AS reconciled_at FROM fresh UNION ALL SELECT s.* FROM s_actions s LEFT JOIN done d ON d.security = s.security AND whole LEFT JOIN fresh f ON f.security = s.security AND f.source_id = s.source_id WHERE d.security IS NULL AND f.security IS NULL",
    "c16_state": f"""SELECT coalesce(t.security, d.security) AS security, coalesce(bootstrapped, false) OR coalesce(d.outcome IN ('completed', 'recovered'), false) AS bootstrapped, CASE WHEN d.reason IS NULL AND whole THEN least(covered_from, d.from_date) ELSE covered_from END AS covered_from, CASE WHEN d.reason IS NULL THEN greatest(covered_through, d.through) ELSE covered_through END AS covered_through,
CASE WHEN d.reason IS NULL THEN least(observed_from, lo) ELSE observed_from END AS observed_from, CASE WHEN d.reason IS NULL THEN greatest(observed_through, hi) ELSE observed_through END AS observed_through,
CASE WHEN d.outcome = 'completed' AND kind = 'reconcile' THEN false WHEN d.outcome = 'completed' AND NOT whole THEN coalesce(reconcile, false) OR EXISTS (SELECT 1 FROM fresh f WHERE f.security = d.security AND changed) ELSE coalesce(reconcile, false) END AS reconcile,
CAST(CASE WHEN d.security IS NULL THEN t.failures WHEN d.reason IS NULL THEN 0 ELSE coalesce(t.failures, 0) + 1 END AS INT) AS failures, CASE WHEN d.security IS NULL THEN next_attempt WHEN d.reason IS NOT NULL THEN {_WAIT} END AS next_attempt, CASE WHEN d.security IS NULL THEN last_error ELSE d.reason END AS last_error
FROM s_state t FULL JOIN (SELECT * FROM judged WHERE outcome <> 'deferred') d ON d.security = t.security""",
    "c16_repairs": f"SELECT r.security, r.from_date, r.through, CASE WHEN completed_at IS NULL AND d.security IS NOT NULL THEN DATE '{NOW[:10]}' ELSE completed_at END AS completed_at, event_id FROM s_repairs r LEFT JOIN done d ON d.security = r.security AND ((kind = 'repair' AND d.from_date = r.from_date AND d.through = r.through) OR (whole AND r.from_date >= d.from_date AND r.through <= d.through))",
}


def _pass(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, sync.Market]:
    """Judged items, written to the shared folder as all tables read them, and the tables after the pass."""
    given = {n: adapters.load(spark, sf_dir, n) for n in _TABLES.split()}

    def table(sql: str, tables: dict[str, DataFrame]) -> DataFrame:
        return spark.sql(sql, **{n: tables[n] for n in set(re.findall(r"\{(\w+)\}", sql))})

    t = {n: table(sql, given) for n, sql in STORED.items()}
    stored = sync.Market(t["s_prices"], t["s_actions"], t["s_state"], t["s_repairs"])
    needs = market.work(given["securities"], stored.prices, stored.state, stored.repairs, START, THROUGH).where("kind != 'none'")
    told = {n: table(sql, {**given, "queue": needs}) for n, sql in TOLD.items()}
    provider = sync.Answers(told["t_prices"], told["t_actions"], t["errors"])

    def kept(rows: DataFrame, name: str) -> DataFrame:
        path = _folder(spark, name)
        rows.write.parquet(path)
        return spark.read.parquet(path)

    chosen = kept(market.chosen_batches(given["batches"], START), "chosen")
    judged, answers = composites.price_pass(stored, given["securities"], provider, (chosen, t["r_prices"], t["r_actions"]), start=START, through=THROUGH, now=NOW)
    judged = kept(judged, "items")
    return judged, sync.applied(stored, judged, answers, NOW)


_COLUMNS = {"c16_prices": "prices", "c16_actions": "actions", "c16_state": "state", "c16_repairs": "repairs"}


def _register_pass(name: str, sql: str) -> None:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        judged, after = _pass(spark, sf_dir)
        if name == "c16_items":
            return judged.select("security", "kind", "from_date", "through", "outcome", "reason", "prices", "actions")
        return sync.totals(judged) if name == "c16_totals" else getattr(after, _COLUMNS[name])

    if name in QUERIES:
        raise ValueError(f"two queries are named {name}")
    QUERIES[name] = build
    stored, told = ("".join(f", {n} AS ({re.sub(r'[{](\w+)[}]', r'\1', q)})" for n, q in of.items()) for of in (STORED, TOLD))
    more = f"{stored}, {_SPANNED}{told}"
    recovered = _APPLIED.replace("1995-06-01", START)
    ORACLES[name] = adapters.with_tables(_TABLES.split(), more + recovered + _JUDGED + " " + sql).replace("WITH ", "WITH RECURSIVE ", 1)


for _name, _sql in _RESULTS.items():
    _register_pass(_name, _sql)
