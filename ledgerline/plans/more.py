"""More registered queries: keyed tables, comparisons, limits and the composites a user calls."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as fn
from ..operators import dividends, events, facts, market, ownership, predicates
from .queries import _ANNOUNCED, _BASE, _KNOWN, _MAPPED, _PRESENT, _STATED, _VALUE_SQL, _VALUES, FACT_TABLES, ORACLES, _mapped, _presence, query
from .round_trips import _stored


@query("k06_securities", "positions", "SELECT cusip AS security, CASE WHEN n % 3 = 1 THEN m ELSE 'new' END AS issuer, CASE WHEN n % 2 = 0 THEN title ELSE 'renamed' END AS title, c AS security_class, 'equity' AS kind FROM s", ctes=", s AS (SELECT cusip, max(title) AS title, min(security_class) AS c, min(manager) AS m, CAST(substring(cusip, 2) AS INT) AS n FROM positions GROUP BY cusip)")
def _(p):
    """Fresh rows lack the issuer of every third security and the title of every other one."""
    old = p.groupBy(F.col("cusip").alias("security")).agg(F.min("manager").alias("issuer"), F.max("title").alias("title"), F.min("security_class").alias("security_class"), F.lit("").alias("kind"))
    n = F.substring("security", 2, 9).cast("int")
    fresh = old.select("security", F.when(n % 3 != 1, "new").alias("issuer"), F.when(n % 2 == 0, "").otherwise("renamed").alias("title"), F.lit("").alias("security_class"), F.lit("equity").alias("kind"))
    return ownership.upsert_securities(old, fresh)


@query("k07_repairs", "repairs", """SELECT event_id, coalesce(completed_at, CASE WHEN (user % 2 = 0 AND from_date >= DATE '2024-01-10' AND through <= DATE '2024-01-28') OR (user % 2 = 1 AND from_date = DATE '2024-01-12' AND through = DATE '2024-01-28') THEN DATE '2024-02-01' END) AS completed_at FROM (SELECT *, CAST(security AS INT) AS user FROM repairs)""")
def _(r):
    """Even securities finish a reconcile run, odd ones a repair of one exact range."""
    even = F.col("security").cast("int") % 2 == 0
    done = r.select("security").distinct().select("security", F.when(even, "reconcile").otherwise("repair").alias("kind"), F.when(even, "2024-01-10").otherwise("2024-01-12").cast("date").alias("from_date"), F.lit("2024-01-28").cast("date").alias("through"))
    return market.complete_repairs(r, done, "2024-02-01").select("event_id", "completed_at")


@query("k07_requeue", "repairs", "SELECT security, from_date, through, CASE WHEN through <> DATE '2024-01-28' THEN completed_at END AS completed_at FROM repairs UNION ALL SELECT DISTINCT security, DATE '2023-12-01', DATE '2023-12-31', CAST(NULL AS DATE) FROM repairs")
def _(r):
    asked = r.where("through = date '2024-01-28'").select("security", "from_date", "through")
    more = r.select("security", F.lit("2023-12-01").cast("date").alias("from_date"), F.lit("2023-12-31").cast("date").alias("through"))
    return market.requeue_repairs(r, asked.unionByName(more)).select("security", "from_date", "through", "completed_at")


@query("k02_replace", "actions", "SELECT security, source_id, CASE WHEN CAST(security AS INT) % 2 = 0 THEN DATE '2024-02-01' ELSE reconciled_at END AS reconciled_at FROM actions WHERE CAST(security AS INT) % 2 = 1 OR date >= DATE '2024-01-10' OR NOT security IN (SELECT security FROM actions WHERE date >= DATE '2024-01-10')")
def _(a):
    """Even securities run a reconcile that knows the later actions only; securities without any keep theirs."""
    fresh = a.where("cast(security as int) % 2 = 0 and date >= date '2024-01-10'").drop("reconciled_at")
    out = market.replace_actions(a, fresh, "2024-02-01")
    return out.select("security", "source_id", "reconciled_at")


_APPLIED = """, base AS (SELECT * FROM batches WHERE kind = 'snapshot' AND from_date <= DATE '1995-06-01' QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY through DESC, from_date, batch) = 1),
chain(symbol, batch, from_date, through, step) AS (SELECT symbol, batch, from_date, through, 0 FROM base UNION ALL SELECT symbol, batch, from_date, through, step + 1 FROM (
  SELECT b.symbol, b.batch, b.from_date, b.through, step, row_number() OVER (PARTITION BY b.symbol ORDER BY b.through DESC, b.from_date, b.batch) AS r FROM chain c JOIN batches b ON b.symbol = c.symbol
  WHERE b.kind = 'incremental' AND b.from_date <= c.through + 1 AND b.through > c.through) WHERE r = 1),
span AS (SELECT b.symbol, b.from_date, max(c.through) AS through FROM base b JOIN chain c ON c.symbol = b.symbol GROUP BY ALL),
applied AS (SELECT symbol, batch, step AS n, NULL::DATE AS f, NULL::DATE AS t FROM chain UNION ALL
  SELECT b.symbol, b.batch, 1000000, b.from_date, b.through FROM batches b JOIN span s ON s.symbol = b.symbol WHERE kind = 'repair' AND b.from_date >= s.from_date AND b.through <= s.through)"""
_LAST = "QUALIFY row_number() OVER (PARTITION BY r.symbol, {} ORDER BY n DESC, f DESC, t DESC, r.batch DESC) = 1"


def _recursive(name: str) -> None:
    ORACLES[name] = ORACLES[name].replace("WITH ", "WITH RECURSIVE ", 1)


@query("w09_recover_batches", "batches", "SELECT s.symbol, s.from_date, s.through, (SELECT count(*) FROM applied a WHERE a.symbol = s.symbol) AS batches FROM span s", ctes=_APPLIED)
def _(b):
    return market.recover_batches(b, "1995-06-01")


@query("w09_recover_values", "batches batch_prices", f"SELECT r.symbol, r.date, r.close, r.open, r.batch FROM batch_prices r JOIN applied a ON a.symbol = r.symbol AND a.batch = r.batch {_LAST.format('r.date')}", ctes=_APPLIED)
def _(b, prices):
    """Batches have prices on five of their days, the same day again where a batch spans one only."""
    once = prices.groupBy("symbol", "batch", "date").agg(F.max_by(F.struct("close", "open"), "close").alias("v")).select("symbol", "batch", "date", "v.*")
    return market.recover_values(once, b, "1995-06-01", values=["close", "open"])


@query("w09_recover_actions", "batches batch_actions", f"SELECT r.symbol, r.source_id, r.date, r.action_type, r.amount, r.batch FROM batch_actions r JOIN applied a ON a.symbol = r.symbol AND a.batch = r.batch {_LAST.format('r.source_id')}", ctes=_APPLIED)
def _(b, actions):
    return market.recover_values(actions, b, "1995-06-01", key="source_id", values=["date", "action_type", "amount"])


for _name in ("w09_recover_batches", "w09_recover_values", "w09_recover_actions"):
    _recursive(_name)
ORACLES["w09_recover_values"] = ORACLES["w09_recover_values"].replace("f DESC, t DESC, r.batch DESC)", "f DESC, t DESC, r.batch DESC, r.close DESC)")


@query("k08_replace_filing", "positions", "SELECT accession, row_number, cusip FROM positions WHERE accession NOT LIKE '%7' UNION ALL SELECT accession, 0, 'NEW' FROM (SELECT DISTINCT accession FROM positions WHERE accession LIKE '%7')")
def _(p):
    cols = ["accession", "row_number", "cusip"]
    fresh = p.where("accession like '%7'").select("accession").distinct().select("accession", F.lit(0).cast("long").alias("row_number"), F.lit("NEW").alias("cusip"))
    return market.upsert(p.select(*cols), fresh, ["accession"])


@query("k10_processed", "events_feed", "SELECT accession, min(sequence) AS sequence FROM events_feed GROUP BY accession")
def _(e):
    old = events.new_accessions(e.where("sequence < 4000"), e.limit(0))
    return old.unionByName(events.new_accessions(e.where("sequence >= 4000"), old)).select("accession", "sequence")


@query("k11_outcomes", "own_filings", "SELECT accession, CASE WHEN family = 'insider' THEN 'unsupported' ELSE status END AS status FROM own_filings")
def _(f):
    rows = f.select("accession", "status", "family", F.lit("").alias("diagnostic"))
    return events.outcomes(rows, rows.where("family = 'insider'").withColumns({"status": F.lit("unsupported"), "diagnostic": F.repeat(F.lit("x"), 5000)})).select("accession", "status")


@query("k07_contained", "repairs", "SELECT event_id, completed_at IS NOT NULL OR (from_date >= DATE '2024-01-10' AND through <= DATE '2024-01-28') AS done FROM repairs")
def _(r):
    spans = r.select("security").distinct().select("security", F.lit("2024-01-10").cast("date").alias("from_date"), F.lit("2024-01-28").cast("date").alias("through"))
    closed = market.contained_repairs(r, spans).select("event_id", F.lit(True).alias("closed"))
    return r.join(closed, "event_id", "left").select("event_id", (F.col("completed_at").isNotNull() | F.coalesce("closed", F.lit(False))).alias("done"))


@query("j12_rows_by_owner", "positions reports", "SELECT p.accession, p.row_number, owner FROM positions p JOIN (SELECT DISTINCT accession, owner FROM reports) o ON o.accession = p.accession")
def _(p, r):
    return ownership.rows_by_owner(p.select("accession", "row_number"), r.select("accession", "owner").distinct())


@query("j15_split_exceptions", FACT_TABLES + " metrics", "SELECT g.cik, p.accession, metric FROM presence p JOIN filings g ON g.accession = p.accession WHERE status = 'missing' AND NOT (form = '8-K' AND metric = 'cash')", ctes=_PRESENT)
def _(*t):
    gaps = _presence(*t).where("status = 'missing'").join(t[5].select("accession", "cik", "form"), "accession")
    return events.split_exceptions(gaps.select("cik", "accession", "metric"), gaps.where("form = '8-K' and metric = 'cash'"))[1]


@query("j16_resolve_members", "members parties", "SELECT ticker, m.cik, party IS NOT NULL AS resolved FROM members m LEFT JOIN parties p ON lpad(party, 10, '0') = m.cik")
def _(m, p):
    known = p.select(fn.canonical_cik(F.col("party")).alias("cik"), F.lit(True).alias("known"))
    return m.join(known, "cik", "left").select("ticker", "cik", F.coalesce("known", F.lit(False)).alias("resolved"))


@query("j17_compare_baseline", FACT_TABLES, "SELECT e.accession, e.unit, e.period, CASE WHEN a.value IS NULL THEN 'missing' WHEN abs(CAST(e.value AS BIGINT) - CAST(a.value AS BIGINT)) = 0 THEN 'match' ELSE 'differs' END AS status FROM best e LEFT JOIN best a ON a.metric = 'assets' AND a.accession = e.accession AND a.unit = e.unit AND a.period = e.period WHERE e.metric = 'liabilities_and_equity'", ctes=_MAPPED)
def _(*t):
    """Totals of the other side of the balance are the expected assets."""
    rows = facts.summary(_mapped(*t)).where("metric in ('assets', 'liabilities_and_equity')")
    rows = rows.select("metric", F.col("accession").alias("cik"), F.col("unit").alias("of"), F.col("period").alias("year"), F.col("value").cast("double").alias("v"))
    actual, expected = (rows.where(f"metric = '{m}'").select("cik", F.col("of").alias("metric"), "year", F.col("v").alias(c)) for m, c in (("assets", "actual"), ("liabilities_and_equity", "expected")))
    return facts.compare_baseline(expected, actual).select(F.col("cik").alias("accession"), F.col("metric").alias("unit"), F.col("year").alias("period"), "status")


@query("j20_sync_by_symbol", "state prices", 'SELECT s.security, s.covered_through, count(*) AS prices, max(date) AS "last" FROM state s JOIN prices p ON p.security = s.security GROUP BY ALL')
def _(s, p):
    return s.select("security", "covered_through").join(market.price_coverage(p, by_symbol=True).select("security", "prices", "last"), "security")


@query("a02_precision_score", "facts", "SELECT id, CASE decimals WHEN 'INF' THEN 2147483647 ELSE CAST(decimals AS INT) END AS score FROM facts")
def _(f):
    return f.select("id", fn.precision_score(F.col("decimals"), F.col("precision")).alias("score"))


@query("a18_dividend_merge", "announcement_texts announcement_filings", f"SELECT substring(sha256(concat_ws('|', accession, declared, ex_date, record_date, payable_date, amount)), 1, 16) AS event_id, amount, accession AS sources FROM ({_ANNOUNCED})")
def _(t, f):
    rows = dividends.announcements(t, f)
    return dividends.merge(rows, rows.where("accession = 'p-1'"), "p-1").select("event_id", "amount", "sources")


@query("a37_ciks", "members", "SELECT DISTINCT cik FROM members")
def _(m):
    return m.select(fn.canonical_cik(F.col("cik")).alias("cik")).distinct()


@query("a35_taxonomy_batch", "facts contexts dimensions concepts", f"SELECT count(DISTINCT accession) AS filings, count(*) AS facts, count(*) FILTER ({_KNOWN}) AS mapped FROM facts")
def _(*t):
    return facts.source_coverage(*t).agg(F.count("*").alias("filings"), F.sum("facts").alias("facts"), F.sum("mapped").alias("mapped"))


@query("w05_latest_coverage", "own_filings", "SELECT family, max(filing_date) AS completed FROM own_filings WHERE parser_version = 1 GROUP BY family")
def _(f):
    rows = f.select("family", F.col("parser_version").alias("version"), F.col("filing_date").alias("completed"), F.col("filing_date").alias("from_date"), F.col("accession").alias("through"))
    return ownership.latest_coverage(rows, 1).select("family", "completed")


@query("w10_ordinals", "reports", "SELECT accession, party, row_number() OVER (PARTITION BY accession ORDER BY party) - 1 AS ordinal FROM (SELECT DISTINCT accession, owner AS party FROM reports)")
def _(r):
    return ownership.ordinals(r.groupBy("accession").agg(F.array_sort(F.collect_set("owner")).alias("parties"))).select("accession", "party", F.col("ordinal").cast("long").alias("ordinal"))


@query("t06_top_terms", "facts concepts", f"SELECT namespace, local, n, (SELECT count(DISTINCT (namespace, local)) FROM facts WHERE NOT {_KNOWN}) AS terms FROM (SELECT namespace, local, count(*) AS n FROM facts WHERE NOT {_KNOWN} GROUP BY namespace, local ORDER BY n DESC, local, namespace LIMIT 2)")
def _(f, t):
    all_terms = facts.open_terms(f, t).agg(F.count_distinct("namespace", "local").alias("terms"))
    return facts.term_counts(f, t, k=2).select("namespace", "local", F.col("facts").alias("n")).crossJoin(all_terms)


@query("t08_statement_order", FACT_TABLES, f"SELECT {_VALUE_SQL} FROM stated", ctes=_STATED)
def _(*t):
    """Stored before the sort, which reads its input twice."""
    return facts.statement_order(_stored(facts.statements(_mapped(*t)).select(*_VALUES, "label"), "stated")).select(*_VALUES)


@query("u05_issue_union", FACT_TABLES, "SELECT accession, 'failed: ' || metric AS issue FROM best WHERE nil UNION SELECT accession, 'unit: ' || unit FROM best WHERE unit LIKE 'unknown%'", ctes=_MAPPED)
def _(*t):
    rows = facts.summary(_mapped(*t))
    one = rows.where("nil").select("accession", F.concat(F.lit("failed: "), "metric").alias("issue"))
    return one.union(rows.where("unit like 'unknown%'").select("accession", F.concat(F.lit("unit: "), "unit"))).distinct()


@query("c05_company_ownership", "positions own_filings parties", "SELECT manager, name, period, cusip, c.accession, c.row_number FROM (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY manager, period, cusip, security_class, put_call, other_managers ORDER BY accession DESC, row_number DESC) = 1) c JOIN parties ON party = manager WHERE cusip = 'P7'", ctes=_BASE)
def _(p, f, parties):
    rows = ownership.effective_positions(p, f).where("cusip = 'P7'").join(parties.select(F.col("party").alias("manager"), "name"), "manager")
    return rows.select("manager", "name", "period", "cusip", "accession", "row_number")


@query("c17_dividend_register", "announcement_texts announcement_filings", f"SELECT cik, count(*) AS events, count(DISTINCT amount) AS amounts FROM ({_ANNOUNCED}) GROUP BY cik")
def _(t, f):
    return dividends.announcements(t, f).groupBy("cik").agg(F.count("*").alias("events"), F.count_distinct("amount").alias("amounts"))


@query("p11_valid_period", "contexts", "SELECT accession, id, id IN ('c0', 'c2', 'c4') AS valid FROM contexts")
def _(c):
    """Turned, unreadable and missing dates beside valid ones."""
    start, end = (F.col(x).cast("string") for x in ("start_date", "end_date"))
    turned = F.when(F.col("id") == "c1", end).when(F.col("id") == "c3", "2020-02-30").otherwise(start)
    return c.select("accession", "id", predicates.valid_period(F.col("instant").cast("string"), turned, F.when(F.col("id") == "c1", start).otherwise(end)).alias("valid"))


@query("p12_company_extension", "facts", "SELECT id, namespace LIKE '%company%' OR namespace LIKE '%/srt/%' AS extension FROM facts")
def _(f):
    return f.select("id", predicates.company_extension(F.col("namespace")).alias("extension"))


@query("p14_valid_period_key", FACT_TABLES, "SELECT id, NOT nil AS valid FROM best", ctes=_MAPPED)
def _(*t):
    """Keys of nil facts are spoilt."""
    key = F.when(F.col("nil"), F.concat(F.lit("in "), "period")).otherwise(F.col("period"))
    return facts.summary(_mapped(*t)).select("id", predicates.valid_period_key(key).alias("valid"))


@query("p15_extraction_failures", "filings facts", "SELECT DISTINCT accession FROM facts WHERE context_ref = 'c9'")
def _(g, f):
    codes = f.where("context_ref = 'c9'").select("accession", F.lit("xbrl_reference").alias("code"))
    return predicates.extraction_failures(g, codes).select("accession")


@query("p16_unchanged_sources", "own_filings", "SELECT source_path AS path FROM own_filings WHERE source_path <> '' AND status = 'failed'")
def _(f):
    files = f.where("source_path != ''").select(F.col("source_path").alias("path"), F.length("accession").alias("length"), F.col("filing_date").alias("modified"))
    done = f.select(F.col("source_path").alias("path"), F.length("accession").alias("length"), F.col("filing_date").alias("modified"), F.when(F.col("status") == "processed", "complete").otherwise("failed").alias("status"))
    return predicates.unchanged_sources(files, done).select("path")
