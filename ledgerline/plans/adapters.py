"""Domain tables as plain SELECTs over the star-schema tables; Spark and DuckDB run the same text."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def _accession(cust: str, year: str) -> str:
    return f"lpad(CAST({cust} AS STRING), 10, '0') || '-' || lpad(CAST({year} % 100 AS STRING), 2, '0') || '-' || lpad(CAST({cust} % 1000000 AS STRING), 6, '0')"


_ACC = _accession("o_custkey", "year(o_orderdate)")
_CIK = "lpad(CAST(o_custkey AS STRING), 10, '0')"
#: Reported concepts by number; the first seven are balances (fixed values).
CONCEPTS = ["Assets", "Liabilities", "StockholdersEquity", "LiabilitiesAndStockholdersEquity", "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest", "AssetsCurrent", "LiabilitiesCurrent", "Revenues", "RevenueFromContractWithCustomerExcludingAssessedTax", "GrossProfit", "NetIncomeLoss", "ProfitLoss", "EarningsPerShareBasic", "EarningsPerShareDiluted", "CustomTerm", "DividendsCommonStockCash", "CommonStockDividendsPerShareDeclared"]
_LOCAL = "CASE l_partkey % 17 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(CONCEPTS)) + " END"
_YEARS = f"SELECT DISTINCT {_ACC} AS accession, year(o_orderdate) AS y FROM {{orders}}"
_MIDDAY = "CAST(ts AS DATE)"
_OWN_ACC = "'own-' || lpad(CAST(l_orderkey AS STRING), 10, '0')"
_ROW = "l_linenumber * 100000000 + l_partkey * 100 + CAST(l_quantity AS BIGINT)"

#: metric, label, statement, tier, concepts with priorities (fixed values); position is file order.
TAXONOMY = [
    ("revenue", "Revenue", "income", "core", [("RevenueFromContractWithCustomerExcludingAssessedTax", 2), ("Revenues", 1), ("SalesRevenueNet", 3), ("RevenueFromContractWithCustomerIncludingAssessedTax", 4), ("RegulatedAndUnregulatedOperatingRevenue", 5), ("SalesRevenueGoodsNet", 6), ("RealEstateRevenueNet", 7)]),
    ("cost_of_revenue", "Cost of revenue", "income", "industry_sensitive", [("CostOfRevenue", 1), ("CostOfGoodsAndServicesSold", 2)]),
    ("gross_profit", "Gross profit", "income", "industry_sensitive", [("GrossProfit", 1)]),
    ("operating_income", "Operating income", "income", "industry_sensitive", [("OperatingIncomeLoss", 1)]),
    ("net_income", "Net income", "income", "core", [("NetIncomeLoss", 1), ("ProfitLoss", 2)]),
    ("eps_diluted", "Diluted EPS", "income", "core", [("EarningsPerShareDiluted", 1)]),
    ("eps_basic", "Basic EPS", "income", "supplemental", [("EarningsPerShareBasic", 1)]),
    ("assets", "Assets", "balance", "core", [("Assets", 1)]),
    ("current_assets", "Current assets", "balance", "industry_sensitive", [("AssetsCurrent", 1)]),
    ("cash", "Cash and equivalents", "balance", "core", [("CashAndCashEquivalentsAtCarryingValue", 1), ("CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalents", 2), ("CashAndDueFromBanks", 3)]),
    ("liabilities", "Liabilities", "balance", "core", [("Liabilities", 1)]),
    ("current_liabilities", "Current liabilities", "balance", "industry_sensitive", [("LiabilitiesCurrent", 1)]),
    ("equity", "Shareholders'' equity", "balance", "core", [("StockholdersEquity", 1)]),
    ("liabilities_and_equity", "Liabilities and equity", "balance", "supplemental", [("LiabilitiesAndStockholdersEquity", 1), ("LiabilitiesAndPartnersCapital", 2)]),
    ("equity_including_noncontrolling_interest", "Equity including noncontrolling interest", "balance", "supplemental", [("StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest", 1), ("PartnersCapitalIncludingPortionAttributableToNoncontrollingInterest", 2)]),
    ("operating_cash_flow", "Operating cash flow", "cash_flow", "core", [("NetCashProvidedByUsedInOperatingActivities", 1), ("NetCashProvidedByUsedInOperatingActivitiesContinuingOperations", 2)]),
    ("investing_cash_flow", "Investing cash flow", "cash_flow", "core", [("NetCashProvidedByUsedInInvestingActivities", 1), ("NetCashProvidedByUsedInInvestingActivitiesContinuingOperations", 2)]),
    ("financing_cash_flow", "Financing cash flow", "cash_flow", "core", [("NetCashProvidedByUsedInFinancingActivities", 1), ("NetCashProvidedByUsedInFinancingActivitiesContinuingOperations", 2)]),
    ("capital_expenditures", "Capital expenditures", "cash_flow", "industry_sensitive", [("PaymentsToAcquirePropertyPlantAndEquipment", 1), ("PaymentsToAcquireProductiveAssets", 2)]),
]
_CONCEPT_ROWS = [(c, "us-gaap", m, label, s, t, p) for m, label, s, t, cs in TAXONOMY for c, p in cs]

#: Every ownership form, two spellings and forms of no family.
FORMS = ["13F-HR", "13F-HR/A", "13F-NT", "13F-NT/A", "3", "3/A", "4", "4/A", "5", "5/A", "SCHEDULE 13D", "SCHEDULE 13D/A", "SCHEDULE 13G", "SCHEDULE 13G/A", "SC 13D", "SC 13D/A", "SC 13G", "SC 13G/A", " sc  13d/a ", "schedule 13g", "13F-CTR", "13F-CTR/A", "10-K", "8-K/A"]

ADAPTERS = {
    "filings": f"SELECT DISTINCT {_ACC} AS accession, {_CIK} AS cik, CASE (o_custkey + year(o_orderdate)) % 5 WHEN 0 THEN '10-K' WHEN 1 THEN '10-Q' WHEN 2 THEN '8-K' WHEN 3 THEN '10-K/A' ELSE '13F-HR' END AS form, make_date(CAST(year(o_orderdate) + 1 AS INT), CAST(1 + o_custkey % 12 AS INT), CAST(1 + o_custkey % 28 AS INT)) AS filing_date, make_date(CAST(year(o_orderdate) AS INT), 12, 31) AS report_date, 'Company ' || CAST(o_custkey AS STRING) AS company FROM {{orders}}",
    "facts": f"SELECT DISTINCT {_ACC} AS accession, 'i1' AS instance, CAST(l_orderkey AS STRING) || '-' || CAST({_ROW} AS STRING) || '-' || CAST(l_suppkey AS STRING) || '-' || CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING) AS id, CASE WHEN l_partkey % 17 = 14 THEN 'http://company.com/2020' WHEN l_suppkey % 29 = 3 THEN 'http://fasb.org/srt/2020' WHEN l_suppkey % 29 = 4 THEN 'http://xbrl.sec.gov/dei/2020' WHEN l_suppkey % 29 = 5 THEN 'urn:x/us-gaap:2009' ELSE 'http://fasb.org/us-gaap/2020' END AS namespace, {_LOCAL} AS local, CAST(CAST(round(l_extendedprice) AS BIGINT) AS STRING) AS value, CASE WHEN l_suppkey % 13 = 0 THEN 'c9' WHEN l_suppkey % 11 = 0 THEN 'c4' WHEN l_partkey % 17 < 7 THEN 'c0' ELSE 'c' || CAST(1 + l_suppkey % 3 AS STRING) END AS context_ref, CASE WHEN l_linenumber % 5 = 0 THEN 'u9' WHEN l_suppkey % 10 = 1 THEN 'u2' ELSE 'u1' END AS unit_ref, CASE l_linestatus WHEN 'F' THEN '-3' ELSE 'INF' END AS decimals, CAST(NULL AS STRING) AS precision, l_discount > 0.09 AS nil FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey",
    "contexts": f"SELECT accession, 'i1' AS instance, c.id, CASE WHEN c.id IN ('c0', 'c4') THEN make_date(CAST(y AS INT), 12, 31) END AS instant, CASE c.id WHEN 'c1' THEN make_date(CAST(y AS INT), 10, 1) WHEN 'c2' THEN make_date(CAST(y AS INT), 1, 1) WHEN 'c3' THEN make_date(CAST(y AS INT), 7, 1) END AS start_date, CASE WHEN c.id IN ('c1', 'c2', 'c3') THEN make_date(CAST(y AS INT), 12, 31) END AS end_date FROM ({_YEARS}) k CROSS JOIN (VALUES ('c0'), ('c1'), ('c2'), ('c3'), ('c4')) AS c(id)",
    "dimensions": f"SELECT accession, 'i1' AS instance, 'c4' AS context_id, 'Segment' AS axis FROM ({_YEARS}) k",
    "units": f"SELECT accession, 'i1' AS instance, u.id, u.unit FROM ({_YEARS}) k CROSS JOIN (VALUES ('u1', 'USD'), ('u2', 'USD/shares')) AS u(id, unit)",
    "concepts": "SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{f}', '{m}', '{label}', '{s}', '{t}', {p}, {i})" for i, (c, f, m, label, s, t, p) in enumerate(_CONCEPT_ROWS)) + ") AS t(concept, family, metric, label, statement, tier, priority, position)",
    "metrics": "SELECT * FROM (VALUES " + ", ".join(f"('{m}', '{t}')" for m, _, _, t, _ in TAXONOMY) + ") AS t(metric, tier)",
    "ratios": "SELECT * FROM (VALUES ('gross_margin', 'gross_profit', 'revenue', 'percent'), ('operating_margin', 'operating_income', 'revenue', 'percent'), ('net_margin', 'net_income', 'revenue', 'percent'), ('current_ratio', 'current_assets', 'current_liabilities', 'multiple'), ('debt_to_equity', 'liabilities', 'equity', 'multiple')) AS t(ratio, numerator, denominator, style)",
    "own_filings": "SELECT 'own-' || lpad(CAST(o_orderkey AS STRING), 10, '0') AS accession, CAST(o_orderdate AS DATE) AS filing_date, CASE o_orderstatus WHEN 'F' THEN '' WHEN 'O' THEN 'RESTATEMENT' ELSE 'NEW HOLDINGS' END AS amendment_type, CASE o_orderpriority WHEN '5-LOW' THEN 'failed' ELSE 'processed' END AS status, CASE o_custkey % 3 WHEN 0 THEN 'insider' WHEN 1 THEN 'institutional' ELSE 'beneficial' END AS family, CASE o_custkey % 2 WHEN 0 THEN 'SCHEDULE 13D' ELSE 'SCHEDULE 13G' END AS form, CAST(o_custkey % 4 AS INT) AS parser_version, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'raw/' || CAST(o_orderkey AS STRING) END AS source_path, CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE 'h' END AS source_hash FROM {orders}",
    "positions": f"SELECT DISTINCT {_OWN_ACC} AS accession, {_ROW} AS row_number, CAST(l_suppkey AS STRING) AS manager, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS period, 'P' || CAST(l_partkey % 500 AS STRING) AS cusip, l_returnflag AS security_class, l_linestatus AS put_call, '' AS other_managers, 'Title ' || CAST(l_partkey % 50 AS STRING) AS title FROM {{lineitem}}",
    "reports": f"SELECT DISTINCT {_OWN_ACC} AS accession, {_ROW} AS row_number, CAST(l_suppkey AS STRING) AS issuer, CAST(o_custkey % 200 AS STRING) AS owner, 'P' || CAST(l_partkey % 20 AS STRING) AS security, CAST(l_shipdate AS DATE) AS event_date, CAST(CAST(l_quantity AS BIGINT) AS STRING) AS percent FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey",
    "holdings": "SELECT 'own-' || lpad(CAST(event_id % 1500 AS STRING), 10, '0') AS accession, event_id AS row_number, CAST(user_id % 20 AS STRING) AS issuer, CAST(user_id AS STRING) AS owner, event_type AS security, event_id % 2 = 0 AS is_derivative, CASE event_id % 3 WHEN 0 THEN 'I' ELSE 'D' END AS direct_or_indirect, '' AS nature, CAST(CAST(ts AS DATE) AS STRING) AS report_date, CAST(CAST(round(value * 100) AS BIGINT) AS STRING) AS amount FROM {events} WHERE event_type IN ('view', 'click')",
    "transactions": "SELECT 'own-' || lpad(CAST(event_id % 1500 AS STRING), 10, '0') AS accession, event_id AS row_number, CAST(user_id % 20 AS STRING) AS issuer, CAST(user_id AS STRING) AS owner, CASE event_type WHEN 'purchase' THEN 'view' ELSE 'click' END AS security, event_id % 2 = 0 AS is_derivative, CASE event_id % 3 WHEN 0 THEN 'I' ELSE 'D' END AS direct_or_indirect, '' AS nature, CAST(CAST(ts AS DATE) AS STRING) AS report_date, CASE WHEN event_id % 4 = 0 THEN '' ELSE CAST(CAST(ts AS DATE) AS STRING) END AS transaction_date, CASE WHEN event_id % 5 = 0 THEN '' ELSE CAST(CAST(round(value * 10) AS BIGINT) AS STRING) END AS shares_after FROM {events} WHERE event_type IN ('purchase', 'signup')",
    "parties": "SELECT CAST(c_custkey AS STRING) AS party, c_name AS name FROM {customer}",
    "members": "SELECT lpad(CAST(c_custkey AS STRING), 10, '0') AS cik, 'T' || CAST(c_custkey AS STRING) AS ticker, c_name AS name FROM {customer} WHERE c_mktsegment = 'BUILDING'",
    "events_feed": "SELECT 'acc-' || CAST(user_id AS STRING) || '-' || CAST(event_id % 40 AS STRING) AS accession, event_id AS sequence, CASE WHEN event_id % 97 = 0 THEN 'bad' ELSE CAST(user_id AS STRING) END AS cik, CASE event_type WHEN 'view' THEN '10-K' WHEN 'click' THEN '10-Q' WHEN 'signup' THEN '8-K' WHEN 'purchase' THEN '4' ELSE 'S-1' END AS form, CASE event_id % 2 WHEN 0 THEN 'ATOM' ELSE 'BATCH' END AS source, make_date(2014 + CAST(event_id % 5 AS INT), 1, 1 + CAST(event_id % 28 AS INT)) AS filing_date, 'Company ' || CAST(user_id AS STRING) AS company, event_type = 'view' AS selected FROM {events}",
    "forms": "SELECT event_id AS sequence, CASE event_id % 24 " + " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(FORMS)) + " END AS form FROM {events}",
    "failure_log": "SELECT event_id AS sequence, CASE event_id % 2 WHEN 0 THEN 'process' ELSE 'download' END AS stage, 'acc-' || CAST(user_id AS STRING) AS accession, CASE event_type WHEN 'error' THEN 'failed' WHEN 'click' THEN 'failed' WHEN 'signup' THEN 'ok' ELSE 'skipped' END AS outcome, 'failure ' || CAST(event_id % 23 AS STRING) AS message FROM {events}",
    "prices": "SELECT CAST(user_id AS STRING) AS security, CAST(ts AS DATE) AS date, max(CASE WHEN event_id % 9 = 0 THEN NULL ELSE value END) AS open, max(value) AS close, min(value) AS adjusted_close FROM {events} GROUP BY user_id, CAST(ts AS DATE)",
    "actions": "SELECT CAST(user_id AS STRING) AS security, 'a' || CAST(event_id AS STRING) AS source_id, CAST(ts AS DATE) AS date, CASE event_type WHEN 'purchase' THEN 'dividend' ELSE 'split' END AS action_type, CASE event_type WHEN 'purchase' THEN value END AS amount, CASE event_type WHEN 'signup' THEN 2.0E0 END AS numerator, CASE event_type WHEN 'signup' THEN 1.0E0 END AS denominator, CASE WHEN event_id % 2 = 0 THEN CAST(ts AS DATE) END AS reconciled_at FROM {events} WHERE event_type IN ('purchase', 'signup')",
    "state": "SELECT CAST(user_id AS STRING) AS security, user_id % 5 <> 0 AS bootstrapped, CASE WHEN user_id % 11 <> 0 THEN min(CAST(ts AS DATE)) END AS covered_from, max(CAST(ts AS DATE)) AS covered_through, min(CAST(ts AS DATE)) AS observed_from, CASE WHEN user_id % 3 = 0 THEN NULL ELSE max(CAST(ts AS DATE)) END AS observed_through, user_id % 7 = 0 AS reconcile, CAST(user_id % 4 AS INT) AS failures FROM {events} WHERE user_id % 10 <> 9 GROUP BY user_id",
    "securities": "SELECT CAST(c_custkey AS STRING) AS security FROM {customer}",
    "repairs": "SELECT CAST(user_id AS STRING) AS security, CAST(ts AS DATE) AS from_date, CASE WHEN event_id % 3 = 0 THEN CAST(ts AS DATE) ELSE make_date(2024, 1, 28) END AS through, CASE WHEN event_id % 2 = 0 THEN CAST(ts AS DATE) END AS completed_at, event_id FROM {events} WHERE event_type = 'error'",
    "batches": "SELECT CAST(o_custkey AS STRING) AS symbol, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'snapshot' WHEN o_orderpriority = '5-LOW' THEN 'repair' ELSE 'incremental' END AS kind, o_orderkey AS batch, CAST(o_orderdate AS DATE) AS from_date, CAST(o_orderdate AS DATE) + CAST(300 * (o_orderkey % 5) AS INT) AS through FROM {orders}",
    "batch_prices": "SELECT symbol, batch, date, CAST(batch % 997 + day AS DOUBLE) AS close, CASE WHEN batch % 3 > 0 THEN CAST(batch % 89 AS DOUBLE) END AS open FROM (SELECT CAST(o_custkey AS STRING) AS symbol, o_orderkey AS batch, CAST(o_orderdate AS DATE) + CAST(300 * (o_orderkey % 5) * day / 4 AS INT) AS date, day FROM {orders} CROSS JOIN (VALUES (0), (1), (2), (3), (4)) AS d(day)) x",
    "batch_actions": "SELECT CAST(o_custkey AS STRING) AS symbol, o_orderkey AS batch, 'a' || CAST(o_orderkey % 2 AS STRING) || '-' || CAST(year(o_orderdate) AS STRING) AS source_id, CAST(o_orderdate AS DATE) AS date, CASE o_orderkey % 2 WHEN 0 THEN 'dividend' ELSE 'split' END AS action_type, CAST(o_orderkey % 83 AS DOUBLE) AS amount FROM {orders}",
    "announcement_texts": "SELECT 'p-' || CAST(page_id AS STRING) AS accession, '<p>' || html || '</p> The board declared a quarterly dividend of $' || CAST(page_id % 9 AS STRING) || '.25 per share, ex-dividend date is March ' || CAST(1 + page_id % 28 AS STRING) || ', 2024; record date: April 2, 2024 &amp; payable on April ' || CAST(3 + page_id % 20 AS STRING) || ', 2024.' AS text FROM {pages}",
    "announcement_filings": "SELECT 'p-' || CAST(page_id AS STRING) AS accession, CAST(page_id % 100 AS STRING) AS cik, make_date(2020 + CAST(page_id % 4 AS INT), 3, 1 + CAST(page_id % 28 AS INT)) AS filing_date FROM {pages}",
    "fx": "SELECT n_name AS currency, 'EUR' AS denominator, CAST(CAST(o_orderdate AS DATE) AS STRING) AS time, avg(o_totalprice) AS value FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey GROUP BY n_name, CAST(o_orderdate AS DATE)",
}
ADAPTERS = {k: v.replace("{{", "{").replace("}}", "}") for k, v in ADAPTERS.items()}

#: What Spark reads in place of a mean of doubles, whose last bits hang on the order of rows: the mean of an exact sum.
EXACT = {"fx": ADAPTERS["fx"].replace("avg(o_totalprice)", "CAST(sum(CAST(o_totalprice AS DECIMAL(28, 10))) AS DOUBLE) / count(*)")}

#: Tables that are joined by accession. Spark deals their rows by it before they are made distinct, so that the joins and
#: groupings that follow find all rows of a filing in one place.
PLACED = {n: ADAPTERS[n].replace(f"SELECT DISTINCT {_ACC} AS accession", f"SELECT DISTINCT * FROM (SELECT /*+ REPARTITION(accession) */ {_ACC} AS accession") + ")" for n in ("filings", "facts")}
PLACED |= {n: ADAPTERS[n].replace(_YEARS.replace("{{", "{").replace("}}", "}"), f"SELECT DISTINCT * FROM (SELECT /*+ REPARTITION(accession) */ {_ACC} AS accession, year(o_orderdate) AS y FROM {{orders}})") for n in ("contexts", "dimensions", "units")}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = EXACT.get(name) or PLACED.get(name) or ADAPTERS[name]
    if name in PLACED:  # joins by accession and more take the placing by accession
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(re.findall(r"\{(\w+)\}", sql))})


def with_tables(names: list[str], rest: str) -> str:
    """SQL for DuckDB: the adapters as common table expressions, then more of them or the query."""
    return "WITH " + ", ".join(f"{n} AS ({re.sub(r'[{](\w+)[}]', r'\1', ADAPTERS[n])})" for n in names) + rest
