"""A price pass over a handful of securities, with the expected tables written out."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import composites, dividends, market, sync

START, THROUGH, NOW = "2024-01-01", "2024-01-31", "2024-02-01 00:00:00"
PRICE = "security string, date string, open double, close double, adjusted_close double"
ACTION = "security string, source_id string, date string, action_type string, amount double, numerator double, denominator double"
STATE = "security string, bootstrapped boolean, covered_from string, covered_through string, observed_from string, observed_through string, reconcile boolean, failures int, next_attempt string, last_error string"


def dated(spark, rows, schema, *columns):
    return spark.createDataFrame(rows, schema).withColumns({c: F.col(c).cast("date") for c in columns})


@pytest.fixture(scope="module")
def after(spark):
    """new: no prices, retained batches; bad: a batch with an unusable price, then an answer; inc: incremental with a changed
    dividend; late: waits for its retry; fail: an error; rec: reconcile; fix: repair with one row outside its span."""
    names = ["new", "bad", "inc", "late", "fail", "rec", "fix"]
    securities = spark.createDataFrame([(n,) for n in names], "security string")
    held = [n for n in names if n not in ("new", "bad")]
    prices = dated(spark, [(n, "2024-01-02", 1.0, 1.0, 1.0) for n in held], PRICE, "date")
    actions = dated(spark, [("inc", "d1", "2024-01-01", "dividend", 1.0, None, None), ("rec", "old", "2024-01-01", "dividend", 1.0, None, None), ("fail", "f1", "2024-01-01", "dividend", 1.0, None, None)], ACTION, "date").withColumn("reconciled_at", F.lit("2024-01-05").cast("date"))
    state = [(n, True, START, "2024-01-20", START, "2024-01-20", n == "rec", 2 if n == "fail" else 0, "2024-03-01 00:00:00" if n == "late" else None, None) for n in held]
    state = dated(spark, state, STATE, "covered_from", "covered_through", "observed_from", "observed_through").withColumn("next_attempt", F.col("next_attempt").cast("timestamp"))
    repairs = dated(spark, [("fix", "2024-01-05", "2024-01-06", None), ("rec", "2024-01-05", "2024-01-06", None), ("inc", "2024-01-05", "2024-01-06", "2024-01-07")], "security string, from_date string, through string, completed_at string", "from_date", "through", "completed_at")
    stored = sync.Market(prices, actions, state, repairs)
    told = [("bad", "2024-01-03", None, 5.0, 5.0), ("new", "2024-01-03", None, 99.0, 99.0), ("inc", "2024-01-25", 2.0, 2.0, 2.0), ("late", "2024-01-25", 2.0, 2.0, 2.0), ("fail", "2024-01-25", 2.0, 2.0, 2.0), ("rec", "2024-01-02", 7.0, 7.0, 7.0), ("fix", "2024-01-05", 2.0, 2.0, 2.0), ("fix", "2024-01-09", 2.0, 2.0, 2.0)]
    told_actions = [("inc", "d1", "2024-01-22", "dividend", 3.0, None, None), ("rec", "s1", "2024-01-03", "split", None, 2.0, 1.0)]
    provider = sync.Answers(dated(spark, told, PRICE, "date"), dated(spark, told_actions, ACTION, "date"), spark.createDataFrame([("fail", "no chart")], "security string, error string"))
    batches = dated(spark, [(n, "snapshot", 1, START, "2024-01-30") for n in ("new", "bad")], "symbol string, kind string, batch int, from_date string, through string", "from_date", "through")
    kept = dated(spark, [("new", 1, "2024-01-04", None, 4.0, 4.0), ("bad", 1, "2024-01-04", None, -4.0, 4.0)], "symbol string, batch int, date string, open double, close double, adjusted_close double", "date")
    kept_actions = dated(spark, [("new", 1, "d", "2024-01-04", "dividend", 1.0, None, None)], "symbol string, batch int, source_id string, date string, action_type string, amount double, numerator double, denominator double", "date")
    retained = (market.chosen_batches(batches, START), kept, kept_actions)
    judged, answers = composites.price_pass(stored, securities, provider, retained, start=START, through=THROUGH, now=NOW)
    judged = judged.cache()
    out = sync.applied(stored, judged, answers, NOW)
    return {r.security: r for r in judged.collect()}, sync.totals(judged).first(), *[t.collect() for t in out]


def test_outcomes(after):
    judged, totals = after[:2]
    assert {n: (r.kind, r.outcome, r.reason) for n, r in judged.items()} == {
        "new": ("bootstrap", "recovered", None), "bad": ("bootstrap", "completed", None), "inc": ("incremental", "completed", None), "late": ("incremental", "deferred", None),
        "fail": ("incremental", "failed", "no chart"), "rec": ("reconcile", "completed", None), "fix": ("repair", "failed", "date outside range"),
    }
    assert totals.asDict() == {"pending": 7, "completed": 4, "recovered": 1, "failed": 2, "deferred": 1, "prices": 4, "actions": 3}


def test_prices_and_actions(after):
    prices = {(r.security, str(r.date)): r.close for r in after[2]}
    first = {(n, "2024-01-02"): 1.0 for n in ("inc", "late", "fail", "fix")}
    assert prices == first | {("new", "2024-01-04"): 4.0, ("bad", "2024-01-03"): 5.0, ("inc", "2024-01-25"): 2.0, ("rec", "2024-01-02"): 7.0}
    actions = {(r.security, r.source_id): (r.amount, r.reconciled_at) for r in after[3]}
    assert actions == {("new", "d"): (1.0, date(2024, 2, 1)), ("inc", "d1"): (3.0, None), ("rec", "s1"): (None, date(2024, 2, 1)), ("fail", "f1"): (1.0, date(2024, 1, 5))}


def test_state_and_repairs(after):
    state = {r.security: r for r in after[4]}
    assert len(after[4]) == 7 and {n: r.reconcile for n, r in state.items() if r.reconcile} == {"inc": True}  # the changed dividend asks for it
    assert (state["new"].covered_from, state["new"].covered_through, state["new"].observed_through) == (date(2024, 1, 1), date(2024, 1, 30), date(2024, 1, 4))
    assert (state["inc"].covered_through, state["inc"].observed_through) == (date(2024, 1, 31), date(2024, 1, 25))
    assert (state["fail"].failures, state["fail"].next_attempt, state["fail"].last_error) == (3, datetime(2024, 2, 1, 0, 4), "no chart")
    assert (state["late"].failures, state["late"].next_attempt, state["late"].covered_through) == (0, datetime(2024, 3, 1), date(2024, 1, 20))
    assert {r.security: r.completed_at for r in after[5]} == {"fix": None, "rec": date(2024, 2, 1), "inc": date(2024, 1, 7)}


def test_dividend_table_shows_events_and_observations(spark):
    events = spark.createDataFrame([("7", "e2", "2024-05-01", "0.5", "USD", "June 1, 2024"), ("7", "e1", "2024-02-01", "0.25", "USD", ""), ("7", "e3", "soon", "1", "USD", "")], "cik string, event_id string, declared string, amount string, currency string, payable_date string")
    seen = spark.createDataFrame([("7", "a1", "2025-01-01", "cash_paid", "2024-12-31", "1500000"), ("7", "a1", "2025-01-01", "per_share_declared", "2024-12-31", "0.75"), ("7", "a2", "2025-01-01", "cash_paid", "", "1"), ("8", "a3", "2025-01-01", "cash_paid", "2024-12-31", "")], "cik string, accession string, filing_date string, kind string, period string, value string")
    got = {(r.label, r.year): r["values"] for r in dividends.dividend_table(events, seen).collect()}
    assert got == {("Declared cash dividends", "2024"): ["$0.25/share", "$0.5/share · payable June 1, 2024"], ("Common-stock cash dividends paid", "2024"): ["$1.5M"], ("Declared dividends per share", "2024"): ["$0.75"]}


def test_observations_keep_dimensions_and_facts_without_context(spark):
    facts = spark.createDataFrame([("a", "i", "c1", "PaymentsOfDividendsCommonStock", "5", "u"), ("a", "i", "gone", "DividendsCommonStockCash", "6", "u"), ("a", "i", "c1", "Assets", "7", "u")], "accession string, instance string, context_ref string, local string, value string, unit_ref string")
    contexts = dated(spark, [("a", "i", "c1", None, "2024-01-01", "2024-12-31")], "accession string, instance string, id string, instant string, start_date string, end_date string", "instant", "start_date", "end_date")
    filings = spark.createDataFrame([("a", "7", "10-K", "2025-02-01")], "accession string, cik string, form string, filing_date string")
    got = {(r.kind, r.period, r.context_start, r.context_end, r.value, r.form) for r in dividends.observations(facts.unionAll(facts), contexts, filings).collect()}
    assert got == {("cash_paid", "2024-12-31", "2024-01-01", "2024-12-31", "5", "10-K"), ("cash_paid", "", "", "", "6", "10-K")}
