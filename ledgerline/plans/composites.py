"""Registered queries of the composites and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as fn
from ..operators import composites, dividends, events, facts, market
from ..sources import landed
from . import adapters
from .queries import _AMOUNTS, _ANNOUNCED, _BASE, _CHECKED, _FAILED, _INSIDER, _KNOWN, _MAPPED, _NEWS, _OBSERVED, _OVERVIEW, _PAID, _PRESENT, _RATIOS, _RELATED, _STATED, _STATUS, _WORK, FACT_TABLES, _announced, _mapped, _news, _status, query
from .round_trips import _folder, _land_xml, _register, _shuffles_removed, _stored


#: Text of one element of each array of a view, and the SQL of the same.
_CELL = ("statement", "group", "metric", "label", "unit", "period", "value", "nil", "context_ref", "decimals")
_VIEW_PARTS = {"summary": _CELL, "values": _CELL, "ratios": ("ratio", "group", "unit", "period", "value"), "checks": ("name", "unit", "period", "status", "expected", "tolerance", "message")}


def _view_text(view: DataFrame) -> DataFrame:
    """Views with every array as text: fields joined by bars, elements in order of their text."""

    def field(x, name: str):
        return F.coalesce((x[name].cast("decimal(38,0)") if name in ("expected", "tolerance") else x[name]).cast("string"), F.lit(""))

    def text(name: str):
        return F.array_join(F.sort_array(F.transform(name, lambda x: F.concat_ws("|", *[field(x, c) for c in _VIEW_PARTS[name]]))), ";").alias(name)

    return view.select("accession", "cik", "form", "company", "filing_date", "report_date", "facts", "instances", "contexts", "dimensional", "status", *map(text, _VIEW_PARTS))


def _best(f, c, d, u, t, g) -> DataFrame:
    """The summary that views are made of, with the columns they show, stored."""
    return _stored(facts.summary(_mapped(f, c, d, u, t, g)).select(*facts.KEYS, "namespace", "local", "value", "nil", "context_ref", "decimals"), "best")


def _part_sql(name: str, source: str) -> str:
    text = " || '|' || ".join(f"""coalesce(CAST("{c}" AS STRING), '')""" for c in _VIEW_PARTS[name])
    return f"LEFT JOIN (SELECT accession, string_agg(t, ';' ORDER BY t) AS t FROM (SELECT accession, {text} AS t FROM ({source})) GROUP BY accession) {name} ON {name}.accession = g.accession "


_VIEW = (
    "SELECT g.accession, cik, form, company, filing_date, report_date, coalesce(f, 0) AS facts, CASE WHEN f > 0 THEN 1 ELSE 0 END AS instances, coalesce(n, 0) AS contexts, coalesce(d, 0) AS dimensional, CASE WHEN f > 0 THEN 'complete' ELSE 'no_xbrl' END AS status, "
    + ", ".join(f"coalesce({n}.t, '') AS {n}" for n in _VIEW_PARTS)
    + " FROM filings g LEFT JOIN (SELECT accession, count(*) AS f, count(*) FILTER (context_ref = 'c4') AS d FROM facts GROUP BY accession) x ON x.accession = g.accession LEFT JOIN (SELECT accession, count(*) AS n FROM contexts GROUP BY accession) k ON k.accession = g.accession "
    + _part_sql("summary", "SELECT * FROM best") + _part_sql("values", "SELECT * FROM stated") + _part_sql("ratios", _RATIOS)
    + _part_sql("checks", "SELECT accession, unit, period, name, status, CASE WHEN status <> 'skipped' THEN x END AS expected, CASE WHEN status <> 'skipped' THEN tol END AS tolerance, CASE WHEN status = 'fail' THEN 'reported value differs from identity' ELSE gap END AS message FROM checked")
)


@query("c01_filing_view", FACT_TABLES + " ratios", _VIEW, ctes=_CHECKED + _AMOUNTS)
def _(f, c, d, u, t, g, r):
    return _view_text(composites.filing_view(g, _best(f, c, d, u, t, g), f, c, d, r))


_HISTORY = """SELECT cik, statement, metric, unit, y AS year, value, accession FROM (SELECT *, dense_rank() OVER (PARTITION BY cik ORDER BY y DESC) AS r FROM (
SELECT g.cik, s.*, CASE WHEN period LIKE 'FY%' THEN substring(period, 3, 4) ELSE substring(period, 1, 4) END AS y FROM stated s JOIN filings g ON g.accession = s.accession
WHERE form IN ('10-K', '10-K/A') AND "group" IN ('Fiscal year', 'Instant') AND NOT nil QUALIFY row_number() OVER (PARTITION BY cik, statement, metric, unit, y ORDER BY filing_date DESC, g.accession DESC, period DESC, local) = 1)) WHERE r <= 10"""


def _of_company(f: DataFrame, g: DataFrame, cik: str) -> tuple[DataFrame, DataFrame]:
    """(facts, filings) of one company, so that a page is not made of the statements of all."""
    mine = g.where(F.col("cik") == cik)
    return f.join(F.broadcast(mine.select("accession")), "accession", "left_semi"), mine


@query("c02_company_history", FACT_TABLES, f"SELECT * FROM ({_HISTORY}) WHERE cik = '0000000007'", ctes=_STATED)
def _(f, c, d, u, t, g):
    f, g = _of_company(f, g, "0000000007")
    return composites.company_history(facts.statements(_mapped(f, c, d, u, t, g)), g, "0000000007")


_DIVIDEND_TABLES = " announcement_texts announcement_filings"


@query("c02_company_page", FACT_TABLES + " members" + _DIVIDEND_TABLES, f"""SELECT l.*, m.ticker FROM (SELECT 'history' AS section, cik, statement, metric AS name, unit, year, value FROM past UNION ALL
SELECT 'dividends', cik, '', label, '', year, shown FROM ({_PAID}) WHERE cik = '0000000007' AND year IN (SELECT year FROM past)) l LEFT JOIN (SELECT cik, min(ticker) AS ticker FROM members GROUP BY cik) m ON m.cik = l.cik""", ctes=_STATED + f", past AS (SELECT * FROM ({_HISTORY}) WHERE cik = '0000000007')")
def _(f, c, d, u, t, g, m, texts, told):
    f, g = _of_company(f, g, "0000000007")
    stated = facts.statements(_mapped(f, c, d, u, t, g))
    return composites.company_page(stated, g, m, _announced(texts, told), dividends.observations(f, c, g), "0000000007")


_FIRST = "(SELECT min(accession) FROM filings)"


@query("c03_filing_detail", FACT_TABLES + " ratios" + _DIVIDEND_TABLES, f"""SELECT 'value' AS kind, metric AS name, unit, period, value FROM stated WHERE NOT nil AND accession = {_FIRST} UNION ALL SELECT 'ratio', ratio, unit, period, value FROM ({_RATIOS}) WHERE accession = {_FIRST}
UNION ALL SELECT 'event', 'announced', 'USD/share', declared, amount FROM ({_ANNOUNCED}) WHERE lpad(cik, 10, '0') = (SELECT cik FROM filings WHERE accession = {_FIRST}) UNION ALL SELECT 'observation', kind, unit_ref, period, value FROM ({_OBSERVED}) WHERE cik = (SELECT cik FROM filings WHERE accession = {_FIRST})""", ctes=_STATED + _AMOUNTS)
def _(f, c, d, u, t, g, r, texts, told):
    first = g.agg(F.min("accession")).first()[0]
    return composites.filing_detail(facts.statements(_mapped(f, c, d, u, t, g)), r, first or "", g, _announced(texts, told), dividends.observations(f, c, g))


@query("c04_filing_search", "filings members", "SELECT f.accession, ticker, filing_date FROM filings f LEFT JOIN members m ON m.cik = f.cik WHERE form = '10-K' AND year(filing_date) = 1997 ORDER BY filing_date DESC, f.accession DESC LIMIT 200")
def _(g, m):
    return composites.search_filings(g, m, form="10-k", year=1997).select("accession", "ticker", "filing_date")


@query("c05_institutional", "positions own_filings parties", """SELECT manager, name, period, cusip, security_class, put_call, accession, row_number FROM (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY manager, period, cusip, security_class, put_call, other_managers ORDER BY accession DESC, row_number DESC) = 1) c
JOIN parties ON party = manager WHERE cusip IN ('P7', 'P8') ORDER BY period DESC, name, cusip, security_class, put_call LIMIT 250""", ctes=_BASE)
def _(p, f, parties):
    cusips = p.where("cusip in ('P7', 'P8')").select("cusip").distinct()
    return composites.company_institutional(p, f, parties, cusips).select("manager", "name", "period", "cusip", "security_class", "put_call", "accession", "row_number")


@query("c05_beneficial", "reports own_filings parties", """SELECT owner, name, security, event_date, accession, row_number FROM (SELECT r.*, filing_date FROM reports r JOIN own_filings f ON f.accession = r.accession WHERE status = 'processed' AND issuer = '3'
QUALIFY row_number() OVER (PARTITION BY issuer, owner, security ORDER BY event_date DESC, filing_date DESC, r.accession DESC, r.row_number DESC) = 1) JOIN parties ON party = owner ORDER BY event_date DESC, filing_date DESC, name, security LIMIT 250""")
def _(r, f, p):
    return composites.company_beneficial(r, f, p, "3").select("owner", "name", "security", "event_date", "accession", "row_number")


@query("c05_insider", "holdings transactions own_filings parties", """SELECT owner, name, security, as_of, accession, row_number, amount FROM (SELECT * FROM ok WHERE issuer = '3' QUALIFY row_number() OVER (PARTITION BY issuer, owner, security, is_derivative, direct_or_indirect, nature ORDER BY as_of DESC, filing_date DESC, accession DESC, row_number DESC, amount DESC) = 1)
JOIN parties ON party = owner ORDER BY as_of DESC, name, security, is_derivative, direct_or_indirect LIMIT 250""", ctes=_INSIDER)
def _(h, t, f, p):
    return composites.company_insider(h, t, f, p, "3").select("owner", "name", "security", "as_of", "accession", "row_number", "amount")


@query("c05_trades", "transactions own_filings", "SELECT t.accession, t.row_number, owner, transaction_date FROM transactions t JOIN own_filings f ON f.accession = t.accession WHERE status = 'processed' AND issuer = '3' ORDER BY transaction_date DESC, filing_date DESC, t.accession DESC, t.row_number LIMIT 100")
def _(t, f):
    return composites.company_trades(t, f, "3").select("accession", "row_number", "owner", "transaction_date")


@query(
    "c06_coverage_report", FACT_TABLES + " metrics",
    "SELECT st.cik, st.accession, st.status, CASE WHEN st.status = 'parsed' THEN coalesce(missing, '') ELSE '' END AS missing FROM st LEFT JOIN (SELECT accession, string_agg(metric, ',' ORDER BY metric) AS missing FROM presence WHERE tier = 'core' AND status = 'missing' GROUP BY accession) m ON m.accession = st.accession",
    ctes=_PRESENT + _STATUS,
)
def _(*t):
    """Stored before the sort, which reads its input twice."""
    listed = facts.presence_by_filing(facts.statements(_mapped(*t[:6])), t[6], t[5]).select("accession", "by_tier")
    listed = _stored(listed, "listed")
    return composites.coverage_report(_status(t[5], t[0]), listed).select("cik", "accession", "status", "missing")


_REPORTED = _PRESENT + _STATUS + f""", gone AS (SELECT accession, metric, tier FROM presence WHERE status = 'missing'),
lists AS (SELECT p.accession, string_agg(metric || '=' || p.status, ',' ORDER BY metric) AS metrics, coalesce(string_agg(metric, ',' ORDER BY metric) FILTER (p.status = 'missing'), '') AS missing FROM presence p GROUP BY p.accession),
tiers AS (SELECT accession, string_agg(t, ';' ORDER BY t) AS t FROM (SELECT accession, tier || ':' || string_agg(metric, ',' ORDER BY metric) AS t FROM gone GROUP BY accession, tier) GROUP BY accession),
hints AS (SELECT accession, string_agg(t, ';' ORDER BY t) AS t FROM (SELECT g.accession, g.metric || ':' || string_agg(q.metric, ',' ORDER BY q.metric) AS t FROM gone g JOIN (VALUES {_RELATED}) AS x(m, r) ON x.m = g.metric JOIN presence q ON q.accession = g.accession AND q.metric = x.r WHERE q.status = 'present' GROUP BY g.accession, g.metric) GROUP BY accession),
basic AS (SELECT DISTINCT accession FROM facts WHERE local = 'EarningsPerShareBasic' AND context_ref = 'c4'),
report AS (SELECT st.cik, st.accession, st.filing_date, st.status, CASE WHEN parsed THEN metrics ELSE '' END AS metrics, CASE WHEN parsed THEN missing ELSE '' END AS missing, CASE WHEN parsed THEN coalesce(r.t, '') ELSE '' END AS by_tier, CASE WHEN parsed THEN coalesce(h.t, '') ELSE '' END AS related,
  CASE WHEN parsed AND b.accession IS NOT NULL AND e.accession IS NOT NULL THEN 'eps_diluted:eps_basic' ELSE '' END AS dimensional FROM (SELECT *, status = 'parsed' AS parsed FROM st) st JOIN lists l ON l.accession = st.accession LEFT JOIN tiers r ON r.accession = st.accession LEFT JOIN hints h ON h.accession = st.accession
  LEFT JOIN basic b ON b.accession = st.accession LEFT JOIN gone e ON e.accession = st.accession AND e.metric = 'eps_diluted')"""


def _covered(*t):
    listed = facts.presence_by_filing(facts.statements(_mapped(*t[:6])), t[6], t[5])
    return composites.coverage_filings(_status(t[5], t[0]), listed, t[0], t[2])


def _listed(column: str):
    """A map of arrays as text, all in order."""
    lines = F.transform(F.map_entries(column), lambda e: F.concat(e["key"], F.lit(":"), F.array_join(F.sort_array(e["value"]), ",")))
    return F.coalesce(F.array_join(F.sort_array(lines), ";"), F.lit("")).alias(column)


@query("c06_filings", FACT_TABLES + " metrics", "SELECT * FROM report", ctes=_REPORTED)
def _(*t):
    """The whole report line of each filing."""
    metrics = F.array_join(F.sort_array(F.transform(F.map_entries("metrics"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ",")
    texts = [F.coalesce(x, F.lit("")).alias(n) for n, x in (("metrics", metrics), ("missing", F.array_join("missing", ",")))]
    lines = _covered(*t).select("cik", "accession", "filing_date", "status", *texts, *map(_listed, ("by_tier", "related", "dimensional")))
    return composites.report_order(_stored(lines, "report"))


@query("c06_totals", FACT_TABLES + " metrics", """SELECT count(*) AS expected, count(*) FILTER (status <> 'missing') AS downloaded, count(*) FILTER (status = 'parsed') AS parsed, count(*) FILTER (status = 'missing') AS missing, count(*) FILTER (status = 'downloaded') AS unparsed, count(*) FILTER (missing <> '') AS with_missing_metrics,
(SELECT coalesce(string_agg(tier || ':' || n, ';' ORDER BY tier), '') FROM (SELECT tier, count(DISTINCT gone.accession) AS n FROM gone JOIN st ON st.accession = gone.accession WHERE status = 'parsed' GROUP BY tier)) AS by_tier FROM (SELECT st.status, report.missing AS missing FROM st JOIN report ON report.accession = st.accession)""", ctes=_REPORTED)
def _(*t):
    tiers = F.transform(F.map_entries("by_tier"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string")))
    report = _stored(_covered(*t).select("accession", "status", "missing", "by_tier"), "report")
    return composites.coverage_totals(report).withColumn("by_tier", F.array_join(F.array_sort(tiers), ";"))


@query("c06_requests", "filings facts", """SELECT 'filings' AS kind, CAST(year(filing_date) AS INT) AS year, '' AS quarters, cik, form, count(*) AS filings FROM st WHERE status = 'missing' GROUP BY ALL UNION ALL
SELECT 'index', CAST(y AS INT), string_agg(q, ',' ORDER BY q), '', '', 0 FROM (SELECT unnest(range(1993, 2003)) AS y), (SELECT unnest([1, 2, 3, 4]) AS q) WHERE (y, q) NOT IN (SELECT (year(filing_date), quarter(filing_date)) FROM filings) AND (y < 2002 OR q <= 3) GROUP BY y""", ctes=_STATUS)
def _(g, f):
    files = g.select(F.year("filing_date").alias("year"), F.quarter("filing_date").alias("quarter"))
    quarters = events.missing_quarters(events.archive_calendar(1993, 2002, 3, g.sparkSession), files)
    return composites.coverage_requests(_status(g, f), quarters).withColumn("quarters", F.array_join(F.transform("quarters", lambda q: q.cast("string")), ","))


@query("a15_quarter_requests", "filings", "SELECT 'index' AS kind, y AS year, q AS quarter FROM (SELECT unnest(range(1993, 2003)) AS y), (SELECT unnest([1, 2, 3, 4]) AS q) WHERE (y, q) NOT IN (SELECT (year(filing_date), quarter(filing_date)) FROM filings) AND (y < 2002 OR q <= 3)")
def _(f):
    files = f.select(F.year("filing_date").alias("year"), F.quarter("filing_date").alias("quarter"))
    return composites.quarter_requests(events.missing_quarters(events.archive_calendar(1993, 2002, 3, f.sparkSession), files))


@query("c07_taxonomy_report", FACT_TABLES, f"""SELECT f.accession, count(*) AS facts, count(*) FILTER ({_KNOWN}) AS mapped, any_value(coalesce(issues, 0)) AS issues FROM facts f LEFT JOIN (SELECT accession, count(DISTINCT issue) AS issues FROM (
SELECT accession, metric, "group", 'several units: ' || metric AS issue FROM best GROUP BY ALL HAVING count(DISTINCT unit) > 1 UNION ALL SELECT accession, metric, "group", 'no values: ' || metric FROM best GROUP BY ALL HAVING count(*) FILTER (NOT nil AND trim(value) <> '') = 0) GROUP BY accession) i ON i.accession = f.accession GROUP BY f.accession""", ctes=_MAPPED)
def _(f, c, d, u, t, g):
    return composites.taxonomy_report(facts.summary(_mapped(f, c, d, u, t, g)), f, c, d, t).select("accession", "facts", "mapped", "issues")


def _reported(stated: DataFrame) -> DataFrame:
    """What presence and identities read of statements: live rows, with the amounts of balances only."""
    cells = [F.when(F.col("statement") == "balance", F.col(c)).alias(c) for c in ("value", "context_ref", "decimals")]
    return stated.where(~F.col("nil")).select("accession", "statement", "metric", "unit", "period", "nil", *cells)


@query("c08_validation", FACT_TABLES + " metrics", """SELECT missing, unparsed, failed_checks, unexplained, CASE WHEN missing + unparsed + failed_checks > 0 THEN 'RED' WHEN unexplained > 0 THEN 'REVIEW' ELSE 'GREEN' END AS gate FROM (SELECT (SELECT count(*) FROM st WHERE status = 'missing') AS missing, (SELECT count(*) FROM st WHERE status = 'downloaded') AS unparsed,
(SELECT count(*) FROM checked WHERE status = 'fail') AS failed_checks, (SELECT count(*) FROM presence p JOIN filings g ON g.accession = p.accession WHERE status = 'missing' AND form <> '8-K') AS unexplained)""", ctes=_CHECKED + _PRESENT.removeprefix(_STATED) + _STATUS)
def _(*t):
    stated = _stored(_reported(facts.statements(_mapped(*t[:6]))), "stated")
    gaps = facts.metric_presence(stated, t[6], t[5]).where("status = 'missing'").join(t[5].select("accession", "cik", "form"), "accession")
    return composites.validation(_status(t[5], t[0]), facts.identities(stated), gaps.select("cik", "accession", "metric"), gaps.where("form = '8-K'"))


@query("c09_baseline_check", FACT_TABLES, "SELECT CASE WHEN a.value IS NULL THEN 'missing' WHEN CAST(e.value AS BIGINT) = CAST(a.value AS BIGINT) THEN 'match' ELSE 'differs' END AS status, count(*) AS n FROM best e LEFT JOIN best a ON a.metric = 'assets' AND a.accession = e.accession AND a.unit = e.unit AND a.period = e.period WHERE e.metric = 'liabilities_and_equity' GROUP BY ALL", ctes=_MAPPED)
def _(*t):
    rows = facts.summary(_mapped(*t)).select(F.col("metric").alias("m"), F.col("accession").alias("cik"), F.col("unit").alias("metric"), F.col("period").alias("year"), F.col("value").cast("double").alias("v"))
    expected, actual = (rows.where(f"m = '{m}'").withColumnRenamed("v", c).drop("m") for m, c in (("liabilities_and_equity", "expected"), ("assets", "actual")))
    return composites.baseline_check(expected, actual)


@query("c10_news_page", "events_feed", f"SELECT accession, sequence, (SELECT count(*) FROM ({_NEWS})) AS items, (SELECT count(*) FROM ({_NEWS}) WHERE selected) AS all_selected FROM ({_NEWS}) WHERE selected AND form = '10-K' ORDER BY sequence DESC LIMIT 100")
def _(e):
    return composites.news_page(_news(e), form="10-K", selection="selected").select("accession", "sequence", "items", "all_selected")


@query("c11_market_status", "securities prices state repairs", f"SELECT kind, count(*) AS securities FROM ({_WORK}) GROUP BY kind")
def _(s, p, t, r):
    return composites.market_status(market.work(s, p, t, r, "2024-01-10", "2024-01-31"))


@query("c12_market_report", "securities prices actions state", f'SELECT o.*, (SELECT min(date) FROM prices) AS "first", (SELECT max(date) FROM prices) AS "last" FROM ({_OVERVIEW}) o')
def _(*t):
    return composites.market_report(*t)


@query("c14_reconcile_index", "filings facts", "SELECT accession FROM filings WHERE form IN ('10-K', '10-Q') AND year(filing_date) BETWEEN 1996 AND 1998 AND accession NOT IN (SELECT accession FROM facts WHERE context_ref = 'c4')")
def _(g, f):
    done = f.where("context_ref = 'c4'").select("accession").distinct()
    return composites.reconcile_index(g, done, forms=["10-K", "10-Q"], from_year=1996, to_year=1998).select("accession")


@query("c15_import_ownership", "own_filings", "SELECT accession, 'beneficial' AS family FROM own_filings WHERE form LIKE 'SCHEDULE%' AND NOT (parser_version = 1 AND status = 'processed' AND source_path <> '' AND source_hash <> '')")
def _(f):
    index = f.select("accession", "form", "filing_date")
    return composites.import_ownership(index, f.select("accession", "parser_version", "status", "source_path", "source_hash"), 1).select("accession", "family")


@query("c16_land_prices", "prices state", """SELECT s.security, least(covered_from, f) AS covered_from, greatest(covered_through, t) AS covered_through FROM state s FULL JOIN (SELECT security, min(date) AS f, max(date) AS t FROM prices WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND close > 0 AND adjusted_close > 0 AND (open IS NULL OR open > 0) GROUP BY security) p ON p.security = s.security WHERE s.security IS NOT NULL""")
def _(p, s):
    batch = p.select("security", "date", "open", "close", "adjusted_close")
    _prices, state, _rejects = composites.land_prices(batch.limit(0), s, batch, "2024-01-05", "2024-01-20")
    return state.join(s.select("security"), "security", "left_semi").select("security", "covered_from", "covered_through")


@query("c19_ownership_status", "own_filings", "SELECT f.family, f.status, count(*) AS filings, any_value(completed) AS completed FROM own_filings f LEFT JOIN (SELECT family, max(filing_date) AS completed FROM own_filings WHERE parser_version = 1 GROUP BY family) c ON c.family = f.family WHERE filing_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' GROUP BY ALL")
def _(f):
    coverage = f.select("family", F.col("parser_version").alias("version"), F.col("filing_date").alias("completed"), F.col("filing_date").alias("from_date"), F.col("accession").alias("through"))
    return composites.ownership_status(f, coverage, 1, from_date="1996-01-01", through="1998-12-31")


@query("c20_requeue", "failure_log", f"SELECT stage, accession, CASE WHEN NOT resolved AND stage = 'process' THEN 0 ELSE attempts END AS attempts FROM ({_FAILED})")
def _(log):
    return composites.requeue(events.failures(log.where("outcome != 'skipped'")), stage="process").select("stage", "accession", "attempts")


@_register("c13_import_index", "filings facts", "SELECT accession, filing_date FROM filings WHERE year(filing_date) >= 1997 AND accession NOT IN (SELECT accession FROM facts WHERE context_ref = 'c4')")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "index")
    rows = adapters.load(spark, sf_dir, "filings").withColumn("path", F.concat(F.lit("edgar/data/1/"), "accession", F.lit(".txt")))
    landed.write_index(rows, path)
    known = adapters.load(spark, sf_dir, "facts").where("context_ref = 'c4'").select("accession").distinct()
    return composites.import_index(landed.read_index(spark, path)[0], known, year=1997).select("accession", "filing_date")


@_register("c18_export_fx", "fx", "SELECT currency || ',' || denominator || ',' || time AS key, CAST(round(value) AS BIGINT) AS whole FROM fx")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series are landed, read and exported as CSV, which is read back."""
    path = _folder(spark, "fx")
    obs = F.concat(F.lit("<Obs><ObsDimension value='"), "time", F.lit("'/><ObsValue value='"), F.col("value").cast("string"), F.lit("'/></Obs>"))
    key = F.concat(F.lit("<Series><SeriesKey><Value id='CURRENCY' value='"), "currency", F.lit("'/><Value id='CURRENCY_DENOM' value='"), "denominator", F.lit("'/></SeriesKey>"))
    rows = adapters.load(spark, sf_dir, "fx").groupBy("currency", "denominator").agg(F.array_join(F.collect_list(obs), "").alias("o"))
    _land_xml(rows.select(F.concat(key, "o", F.lit("</Series>")).alias("value")), "DataSet", path)
    market.fx_pivot(landed.read_fx(spark, path)).write.csv(f"{path}-csv", header=True)
    out = spark.read.csv(f"{path}-csv", header=True, schema="currency string, denominator string, time string, value double")
    return out.select(F.concat_ws(",", "currency", "denominator", "time").alias("key"), F.round("value").cast("long").alias("whole"))


@_register("c21_feed_cycle", "filings facts", "SELECT accession, company FROM filings WHERE accession NOT IN (SELECT accession FROM facts WHERE context_ref = 'c4')")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "feed")
    entry = F.concat(
        F.lit("<entry><title>"), "form", F.lit(" - "), "company", F.lit(" ("), "cik", F.lit(") (Filer)</title><link rel='alternate' href='https://h/Archives/edgar/data/1/"), F.replace("accession", F.lit("-"), F.lit("")), F.lit("/x.htm'/><summary type='html'>none</summary><updated>2024-01-01</updated></entry>"),
    )
    _land_xml(adapters.load(spark, sf_dir, "filings").select(entry.alias("value")), "feed", path)
    feed, _dead = landed.read_atom_feed(spark, path)
    done = adapters.load(spark, sf_dir, "facts").where("context_ref = 'c4'").select("accession").distinct()
    return composites.feed_cycle(feed, done).select("accession", "company")


@_register("s20_views", FACT_TABLES + " ratios", _CHECKED + _AMOUNTS + " " + _VIEW)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole nested views are written as JSON and read back; those of another version are left."""
    f, c, d, u, t, g, r = (adapters.load(spark, sf_dir, n) for n in (FACT_TABLES + " ratios").split())
    views = composites.filing_view(g, _best(f, c, d, u, t, g), f, c, d, r)
    path = _folder(spark, "views")
    with _shuffles_removed(spark):
        composites.write_views(views, f"{path}/now")
    composites.write_views(spark.read.schema(views.schema).json(f"{path}/now").withColumn("version", F.lit(0)), f"{path}/old")
    return _view_text(composites.read_views(spark, f"{path}/*", views.schema))


@_register("s04_raw_index", "filings", "SELECT CAST(CAST(cik AS BIGINT) AS STRING) AS cik, company, accession AS path, 'good' AS part FROM filings UNION ALL SELECT NULL, NULL, 'short line', 'rejected'")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw quarterly files with header lines and one short line."""
    path = _folder(spark, "raw")
    f = adapters.load(spark, sf_dir, "filings").select(F.year("filing_date").alias("y"), F.concat_ws("|", fn.bare_cik(F.col("cik")), "company", "form", F.col("filing_date").cast("string"), "accession").alias("line"))
    head = "\n".join(["header"] * 11)
    files = f.groupBy("y").agg(F.concat(F.lit(head + "\n"), F.array_join(F.collect_list("line"), "\n"), F.when(F.col("y") == f.agg(F.min("y")).first()[0], "\nshort line").otherwise("")).alias("value"))
    files.repartition("y").select("value").write.option("maxRecordsPerFile", 1).text(path)
    rows, rejects = landed.read_raw_index(spark, path)
    return rows.select("cik", "company", "path", F.lit("good").alias("part")).unionByName(rejects.select(F.lit(None).cast("string").alias("cik"), F.lit(None).cast("string").alias("company"), F.col("value").alias("path"), F.lit("rejected").alias("part")))


@_register("s22_reports", "filings facts", "SELECT form, accession, status FROM (SELECT accession, CASE WHEN v THEN 'parsed' WHEN filing_date < DATE '1998-06-01' THEN 'downloaded' ELSE 'missing' END AS status FROM filings g LEFT JOIN (SELECT accession AS a, true AS v FROM facts WHERE context_ref = 'c4' GROUP BY accession) x ON x.a = g.accession), (VALUES ('json'), ('text')) AS f(form)")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status report in both forms, read back."""
    g, f = (adapters.load(spark, sf_dir, n) for n in ("filings", "facts"))
    report = _status(g, f).select("accession", "status")
    path = _folder(spark, "reports")
    for form in ("json", "text"):
        composites.write_report(report, f"{path}/{form}", form=form)
    lines = spark.read.text(f"{path}/text").select(F.lit("text").alias("form"), *[F.get(F.split("value", "\t"), F.lit(i)).alias(c) for i, c in enumerate(("accession", "status"))])
    return lines.unionByName(spark.read.schema("accession string, status string").json(f"{path}/json").withColumn("form", F.lit("json")))
