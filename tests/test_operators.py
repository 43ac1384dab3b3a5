import pytest
from pyspark.sql import functions as F

from ledgerline.operators import events, facts, market, ownership, predicates
from ledgerline.sources import landed, ownership_forms

FACT = "accession string, instance string, ordinal string, id string, namespace string, local string, value string, context_ref string, unit string, decimals string, precision string, nil boolean, priority int, statement string, group string, metric string, label string, tier string, period string"
VALUE = "accession string, statement string, group string, metric string, label string, tier string, unit string, period string, namespace string, local string, value string, nil boolean, context_ref string, decimals string"


def value(metric, amount, *, ctx="c", unit="USD", decimals="0", nil=False, period="2024-12-31", acc="a"):
    return (acc, "balance", "Instant", metric, metric, "core", unit, period, "us-gaap", metric, amount, nil, ctx, decimals)


def test_best_fact_does_not_depend_on_order(spark):
    def fact(i, v, priority, decimals, nil=False):
        return ("a", "i", i, i, "us-gaap", "Revenues", v, "c1", "USD", decimals, None, nil, priority, "income", "Fiscal year", "revenue", "Revenue", "core", "FY2024")

    rows = [fact("f3", "1", 2, "INF"), fact("f2", "2", 1, "-6"), fact("f1", "3", 1, "-3"), fact("f0", "4", 1, "-3", True)]
    for order in (rows, rows[::-1]):
        got = facts.best_fact(spark.createDataFrame(order, FACT), facts.KEYS).collect()
        assert [r.value for r in got] == ["3"]


def test_liabilities_and_equity_are_filled_in(spark):
    rows = [value("liabilities_and_equity", "100"), value("equity_including_noncontrolling_interest", "40"), value("liabilities_and_equity", "9", unit="EUR", ctx="x"), value("equity", "1", unit="EUR", ctx="y")]
    out = facts.equity_fallback(facts.derive_liabilities(spark.createDataFrame(rows, VALUE)))
    got = {(r.metric, r.unit): r.value for r in out.collect()}
    assert got["liabilities", "USD"] == "60" and got["equity", "USD"] == "40" and ("liabilities", "EUR") not in got


@pytest.mark.parametrize(
    ("rows", "status"),
    [
        ([value("assets", "100"), value("liabilities_and_equity", "90")], "fail"),
        ([value("assets", "100000", decimals="-3"), value("liabilities_and_equity", "100900", decimals="-3")], "pass"),
        ([value("assets", "100"), value("liabilities_and_equity", "100", ctx="d")], "skipped"),
        ([value("assets", "100"), value("liabilities", "60"), value("equity", "40")], "pass"),
    ],
)
def test_identities(spark, rows, status):
    got = {r.name: r.status for r in facts.identities(spark.createDataFrame(rows, VALUE)).collect()}
    direct = any(r[3] == "liabilities_and_equity" for r in rows)
    assert got["assets = liabilities_and_equity" if direct else "assets = liabilities + equity"] == status
    assert ("assets = liabilities + equity" in got) != direct


def test_restatement_and_added_holdings(spark):
    filings = spark.createDataFrame([("1", "2026-02-01", ""), ("2", "2026-02-02", "RESTATEMENT"), ("3", "2026-02-03", "NEW HOLDINGS")], "accession string, filing_date string, amendment_type string").withColumn("status", F.lit("processed"))
    rows = [("1", 0, "111111111"), ("1", 1, "222222222"), ("2", 0, "111111111"), ("3", 0, "333333333")]
    positions = spark.createDataFrame(rows, "accession string, row_number int, cusip string").withColumns({"manager": F.lit("300"), "period": F.lit("2025-12-31"), "security_class": F.lit(""), "put_call": F.lit(""), "other_managers": F.lit("")})
    assert sorted(r.cusip for r in ownership.effective_positions(positions, filings).collect()) == ["111111111", "333333333"]


def test_recovery_stops_at_the_first_gap(spark):
    rows = [("s", "snapshot", "2024-01-01", "2024-01-10"), ("s", "incremental", "2024-01-11", "2024-01-15"), ("s", "incremental", "2024-01-05", "2024-01-12"), ("s", "incremental", "2024-01-17", "2024-01-20"), ("t", "snapshot", "2024-01-05", "2024-01-10")]
    batches = spark.createDataFrame(rows, "symbol string, kind string, f string, t string").select("symbol", "kind", F.col("f").alias("batch"), F.col("f").cast("date").alias("from_date"), F.col("t").cast("date").alias("through"))
    got = market.recover_batches(batches, "2024-01-02").collect()
    assert [(r.symbol, str(r.from_date), str(r.through), r.batches) for r in got] == [("s", "2024-01-01", "2024-01-15", 2)]


def test_recovery_takes_the_batch_that_reaches_furthest(spark):
    """B and D make the chain; E fits but is never chosen; the repair from the base's own start counts, those beyond the span don't."""
    rows = [
        ("A", "snapshot", "2024-01-01", "2024-01-10"), ("A2", "snapshot", "2024-01-02", "2024-01-09"), ("B", "incremental", "2024-01-11", "2024-01-30"), ("E", "incremental", "2024-01-25", "2024-02-04"), ("C", "incremental", "2024-01-05", "2024-01-20"),
        ("D", "incremental", "2024-01-31", "2024-02-09"), ("G", "incremental", "2024-02-12", "2024-02-20"), ("R1", "repair", "2024-01-01", "2024-01-03"), ("R2", "repair", "2023-12-31", "2024-01-02"), ("R3", "repair", "2024-02-09", "2024-02-10"),
    ]
    batches = spark.createDataFrame([("s", k, b, f, t) for b, k, f, t in rows], "symbol string, kind string, batch string, f string, t string").select("symbol", "kind", "batch", F.col("f").cast("date").alias("from_date"), F.col("t").cast("date").alias("through"))
    got = market.chosen_batches(batches, "2024-01-05").orderBy("apply_order").collect()
    assert [r.batch for r in got] == ["A", "B", "D", "R1"]
    assert {(str(r.covered_from), str(r.covered_through)) for r in got} == {("2024-01-01", "2024-02-09")}
    prices = spark.createDataFrame([("s", b, d, float(i)) for i, (b, d) in enumerate([("A", "2024-01-02"), ("R1", "2024-01-02"), ("B", "2024-01-26"), ("E", "2024-01-26"), ("R2", "2024-01-02"), ("D", "2024-02-01")])], "symbol string, batch string, date string, close double")
    assert {(r.date, r.close, r.batch) for r in market.recover_values(prices, batches, "2024-01-05", values=["close"]).collect()} == {("2024-01-02", 1.0, "R1"), ("2024-01-26", 2.0, "B"), ("2024-02-01", 5.0, "D")}
    assert market.recover_batches(batches.where("kind != 'snapshot'"), "2024-01-05").count() == 0


def test_work_lifecycle(spark):
    securities = spark.createDataFrame([(x,) for x in "abcde"], "security string")
    prices = spark.createDataFrame([(x,) for x in "bcde"], "security string")
    state = spark.sql("SELECT * FROM VALUES ('b', true, date '2024-01-01', date '2024-01-31', date '2024-01-31', false), ('c', true, date '2024-01-01', date '2024-01-31', date '2024-01-20', false), ('d', true, date '2024-01-01', date '2024-01-31', date '2024-01-20', true), ('e', true, date '2024-02-01', date '2024-02-10', null, false) AS t(security, bootstrapped, covered_from, covered_through, observed_through, reconcile)")
    repairs = spark.sql("SELECT 'b' AS security, date '2024-01-05' AS from_date, date '2024-01-06' AS through, CAST(NULL AS DATE) AS completed_at")
    got = {r.security: r.kind for r in market.work(securities, prices, state, repairs, "2024-01-01", "2024-01-31").collect()}
    assert got == {"a": "bootstrap", "b": "repair", "c": "incremental", "d": "reconcile", "e": "bootstrap"}


def test_failures_restart_after_resolution(spark):
    log = spark.createDataFrame([(1, "s", "x", "failed"), (2, "s", "x", "ok"), (3, "s", "x", "failed"), (4, "s", "y", "ok")], "sequence int, stage string, accession string, outcome string")
    got = {r.accession: (r.attempts, r.resolved) for r in events.failures(log).collect()}
    assert got == {"x": (1, False), "y": (0, True)}


def test_selection_reasons_in_order(spark):
    rows = [("1", "S-1"), ("1", "8-K"), ("x", "10-K"), ("2", "10-K"), ("1", "10-K")]
    members = spark.createDataFrame([("0000000001",)], "cik string")
    got = [r.selection_reason.split(" ")[:2] for r in predicates.selection(spark.createDataFrame(rows, "cik string, form string"), members, ["10-K"], "set").collect()]
    assert got == [["form", "is"], ["form", "is"], ["filing", "has"], ["company", "is"], ["supported", "form"]]


def test_index_reader(spark, tmp_path):
    (tmp_path / "2024-QTR1.tsv").write_text("0000320193|A|10-K|2024-02-01|edgar/data/1/a.txt\r\n\n1|B|10-Q|2024-13-01|p\n2|C|8-K|2024-03-01|p|i\n3|D\n")
    good, bad = landed.read_index(spark, str(tmp_path))
    assert sorted((r.cik, r.index_path) for r in good.collect()) == [("2", "i"), ("320193", None)]
    assert sorted(r.reason for r in bad.collect()) == ["column count", "invalid date"]


def test_feed_reader_sets_dead_letters_apart(spark, tmp_path):
    entry = "<entry><title>10-K - ACME (0000000001) (Filer)</title><link href='https://x/Archives/edgar/data/1/{}-index.htm'/><summary type='html'>&lt;b&gt;CIK:&lt;/b&gt; 1</summary><category term='10-K'/></entry>"
    (tmp_path / "f.xml").write_text("<feed xmlns='http://www.w3.org/2005/Atom'>" + entry.format("0000000001-24-000001") * 2 + entry.format("none") + "</feed>")
    good, dead = landed.read_atom_feed(spark, str(tmp_path))
    assert [(r.accession, r.cik, r.form, r.company) for r in good.collect()] == [("0000000001-24-000001", "0000000001", "10-K", "ACME")]
    assert dead.count() == 1


def test_insider_form(spark):
    xml = "<ownershipDocument><issuer><issuerCik>1</issuerCik></issuer><reportingOwner><reportingOwnerId><rptOwnerCik>7</rptOwnerCik></reportingOwnerId></reportingOwner><reportingOwner><reportingOwnerId><rptOwnerCik>8</rptOwnerCik></reportingOwnerId></reportingOwner><nonDerivativeTable><nonDerivativeTransaction><securityTitle><value>Common</value></securityTitle><transactionDate><value>2024-01-02</value></transactionDate><postTransactionAmounts><sharesOwnedFollowingTransaction><value>10</value></sharesOwnedFollowingTransaction></postTransactionAmounts></nonDerivativeTransaction></nonDerivativeTable></ownershipDocument>"
    got = ownership_forms.insider_rows(spark.createDataFrame([("a", xml)], "accession string, xml string")).collect()
    assert sorted((r.owner, r.security, r.shares_after) for r in got) == [("7", "Common", "10"), ("8", "Common", "10")]


def test_keyed_table_touches_its_own_buckets(spark, tmp_path):
    from ledgerline.streaming.keyed import KeyedTable

    rows = spark.range(500).select(F.col("id").cast("string").alias("accession"), F.lit(0).alias("n"))
    table = KeyedTable(spark, str(tmp_path / "t"), rows.schema, ["accession"], buckets=32)
    assert table.read().count() == 0
    table.upsert(rows)
    fresh = rows.limit(10).withColumn("n", F.lit(1))
    before = table.held(0)
    assert table.upsert(fresh) <= 10
    assert sum(table.held(1)[b] != n for b, n in before.items()) <= 10
    want = sorted((r.accession, r.n) for r in table.read().collect())
    assert len(want) == 500 and sum(n for _, n in want) == 10
    assert sorted((r.accession, r.n) for r in table.read(0).collect()) == sorted((str(i), 0) for i in range(500))
    for _ in range(2):  # a batch that runs again starts from what was there before it
        table.merge(fresh, 1, lambda old, new: old.join(new.select("accession"), "accession", "left_anti").unionByName(new))
        assert sorted((r.accession, r.n) for r in table.read().collect()) == want
    table.merge(fresh.withColumn("n", F.lit(2)), 2, lambda old, new: old.join(new.select("accession"), "accession", "left_anti"))  # keys can go
    assert table.read().count() == 490
    table.vacuum()
    assert table.versions() == [2] and table.read().count() == 490


def test_holdings_covers_reject_with_reasons(spark):
    cover = "<edgarSubmission xmlns='urn:13f'><headerData><submissionType>{type}</submissionType><filerInfo><periodOfReport>03-31-2024</periodOfReport><filer><credentials><cik>7</cik></credentials></filer></filerInfo></headerData><formData>{cover}</formData></edgarSubmission>"
    page = "<coverPage><reportCalendarOrQuarter/><filingManager><name> M </name></filingManager><reportType>13F  holdings report</reportType></coverPage>"
    rows = [("a", cover.format(type="13F-HR/A", cover=page), "13F-HR/A"), ("b", cover.format(type="13F-HR", cover=""), "13F-HR"), ("c", cover.format(type="13F-HR", cover=page), "13F-NT"), ("d", cover.format(type="13F-HR", cover=page.replace(" M ", " ")), "13F-HR")]
    docs = spark.createDataFrame(rows, "accession string, xml string, form string")
    good, bad = ownership_forms.holdings_covers(docs)
    (r,) = good.collect()
    assert (r.manager_cik, r.manager, r.period, r.amendment, r.amendment_type, r.report_kind, r.entries) == ("7", "M", "2024-03-31", True, "RESTATEMENT", "13F HOLDINGS REPORT", None)
    assert {r.accession: r.reason for r in bad.collect()} == {"b": "no cover page", "c": "document type differs", "d": "no filing manager"}


def test_coverage_report_says_what_is_missing_and_what_hints_at_it(spark):
    values = spark.createDataFrame([value("liabilities_and_equity", "9", acc="a"), value("eps_basic", "1", acc="a"), value("cash", "1", acc="b", nil=True)], VALUE)
    metrics = spark.createDataFrame([("eps_diluted", "core"), ("eps_basic", "supplemental"), ("liabilities", ""), ("liabilities_and_equity", "supplemental"), ("cash", "industry_sensitive")], "metric string, tier string")
    filings = spark.createDataFrame([("a",), ("b",)], "accession string")
    got = {r.accession: r for r in facts.presence_by_filing(values, metrics, filings).collect()}
    assert got["a"].metrics == {"cash": "missing", "eps_basic": "present", "eps_diluted": "missing", "liabilities": "missing", "liabilities_and_equity": "present"}
    assert got["a"].missing == ["cash", "eps_diluted", "liabilities"] and got["a"].by_tier == {"core": ["eps_diluted", "liabilities"], "industry_sensitive": ["cash"]}
    assert got["a"].related == {"eps_diluted": ["eps_basic"], "liabilities": ["liabilities_and_equity"]}
    assert got["b"].metrics["eps_basic"] == "supplemental_missing" and got["b"].missing == got["a"].missing and got["b"].related == {}


def test_metrics_are_not_shuffled_for_each_filing(spark):
    values = spark.createDataFrame([("a", "cash", False), ("a", "cash", False), ("a", "eps", True), ("b", None, False)], "accession string, metric string, nil boolean")
    metrics = spark.createDataFrame([("cash", "core"), ("eps", "supplemental"), ("assets", None)], "metric string, tier string")
    filings = spark.createDataFrame([("a",), ("b",), ("c",)], "accession string")
    rows = facts.metric_presence(values, metrics, filings)
    assert sorted((r.accession, r.metric, r.status) for r in rows.collect()) == sorted((a, m, "present" if (a, m) == ("a", "cash") else "supplemental_missing" if m == "eps" else "missing") for a in "abc" for m in ("cash", "eps", "assets"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "hashpartitioning" in line and "metric" in line]


def test_stored_views_are_compressed(spark, tmp_path):
    from ledgerline.operators import composites

    views = spark.createDataFrame([("a", 1, ["x"]), ("b", 0, [])], "accession string, version int, cells array<string>")
    composites.write_views(views, f"{tmp_path}/v")
    assert {p.suffix for p in (tmp_path / "v").glob("part-*")} == {".gz"}
    assert [tuple(r) for r in composites.read_views(spark, f"{tmp_path}/v", views.schema).collect()] == [("a", 1, ["x"])]


def test_exported_rates_keep_their_decimals(spark):
    rows = spark.createDataFrame([("A", "EUR", "1", 12345.49996), ("A", "EUR", "2", 12345678.5), ("A", "EUR", "3", 100.0), ("A", "EUR", "4", None)], "currency string, denominator string, time string, value double")
    assert [r.value for r in market.fx_pivot(rows).collect()] == ["12345.49996", "12345678.5", "100", None]
