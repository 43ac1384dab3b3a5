"""The composite questions that a user asks, each a composition of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as fn
from . import dividends, events, facts, market, ownership, predicates, sync

#: Version of stored views; views of another version are not read.
VIEW_VERSION = 1
#: Rows of a company's ownership lists.
LISTED, LISTED_TRADES = 250, 100


def filing_view(filings: DataFrame, best: DataFrame, f: DataFrame, contexts: DataFrame, dimensions: DataFrame, specs: DataFrame) -> DataFrame:
    """One row per filing: its metadata, counts of its source, and as arrays its summary, statement values, ratios and identity
    checks; a part that a filing lacks is empty.

    best: facts.summary. It is read by every part, so store it where it is costly; dealt by accession once, its parts stay there.
    """

    def part(rows: DataFrame, name: str, *columns: str) -> DataFrame:
        return rows.groupBy("accession").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(name))

    # A generator lets no filter and no choice of columns through, so that all parts share one exchange.
    best = best.repartition("accession").select("accession", F.inline(F.array(F.struct(*[c for c in best.columns if c != "accession"]))))
    stated = facts.stated(best)
    cell = ("statement", "group", "metric", "label", "unit", "period", "value", "nil", "context_ref", "decimals")
    parts = [
        part(best, "summary", *cell),
        part(stated, "values", *cell),
        part(facts.ratios(stated, specs), "ratios", "ratio", "group", "unit", "period", "value"),
        part(facts.identities(stated), "checks", "name", "unit", "period", "status", "expected", "actual", "tolerance", "message"),
    ]
    out = facts.view_counts(filings, f, contexts, dimensions).join(filings.select("accession", "cik", "form", "company", "filing_date", "report_date"), "accession")
    for rows in parts:
        name = rows.columns[1]
        out = out.join(rows, "accession", "left").withColumn(name, F.coalesce(name, F.array().cast(rows.schema[name].dataType)))
    return out.withColumn("version", F.lit(VIEW_VERSION))


def write_views(views: DataFrame, path: str) -> None:
    """Nested JSON, one line per view, compressed: names and repeated cells make up most of it."""
    views.write.option("compression", "gzip").json(path)


def read_views(spark, path: str, schema) -> DataFrame:
    """Stored views of the present version."""
    return spark.read.schema(schema).json(path).where(F.col("version") == VIEW_VERSION)


def company_history(stated: DataFrame, filings: DataFrame, cik: str) -> DataFrame:
    """Annual values of one company, in the order of its page."""
    mine = filings.where(F.col("cik") == cik)
    return facts.history(stated, mine).orderBy("statement", "metric", "unit", F.desc("year"))


def company_page(stated: DataFrame, filings: DataFrame, members: DataFrame, events_: DataFrame, observed: DataFrame, cik: str) -> DataFrame:
    """Lines of a company's page: section (history or dividends), ticker, statement, name, unit, year, shown. The history is that
    of company_history; the dividend table keeps its years. A company without annual values has no page."""
    rows = facts.history(stated, filings.where(F.col("cik") == cik))
    past = rows.select(F.lit("history").alias("section"), "cik", "statement", F.col("metric").alias("name"), "unit", "year", "value")
    paid = dividends.dividend_table(events_.where(F.col("cik") == cik), observed.where(F.col("cik") == cik)).join(rows.select("year").distinct(), "year", "left_semi")
    paid = paid.select(F.lit("dividends").alias("section"), "cik", F.lit("").alias("statement"), F.col("label").alias("name"), F.lit("").alias("unit"), "year", F.array_join("values", "; ").alias("value"))
    ticker = members.where(F.col("cik") == cik).groupBy("cik").agg(F.min("ticker").alias("ticker"))
    return past.unionByName(paid).join(ticker, "cik", "left").orderBy("section", "statement", "name", "unit", F.desc("year"))


def filing_detail(stated: DataFrame, specs: DataFrame, accession: str, filings: DataFrame, events_: DataFrame, observed: DataFrame) -> DataFrame:
    """One filing as lines: kind, name, unit, period, value. Values and ratios are the filing's; announced (event) and observed
    (observation) dividends are those of its company."""
    mine = stated.where(F.col("accession") == accession)
    values = mine.where(~F.col("nil")).select(F.lit("value").alias("kind"), F.col("metric").alias("name"), "unit", "period", "value")
    fractions = facts.ratios(mine, specs).select(F.lit("ratio").alias("kind"), F.col("ratio").alias("name"), "unit", "period", "value")
    company = filings.where(F.col("accession") == accession).select("cik").distinct()
    told = events_.join(company, "cik", "left_semi").select(F.lit("event").alias("kind"), F.col("status").alias("name"), F.concat("currency", F.lit("/share")).alias("unit"), F.col("declared").alias("period"), F.col("amount").alias("value"))
    seen = observed.join(company, "cik", "left_semi").select(F.lit("observation").alias("kind"), F.col("kind").alias("name"), F.col("unit_ref").alias("unit"), "period", "value")
    return values.unionByName(fractions).unionByName(told).unionByName(seen)


def search_filings(filings: DataFrame, members: DataFrame, *, limit: int = 200, **filters) -> DataFrame:
    """Filings that fit, with their ticker, newest first."""
    found = events.filing_ticker(predicates.filing_search(filings, members, **filters), members)
    return found.orderBy(F.desc("filing_date"), F.desc("accession")).limit(limit)


def company_institutional(positions: DataFrame, filings: DataFrame, parties: DataFrame, cusips: DataFrame) -> DataFrame:
    """Effective positions in a company's securities (cusip), latest period first."""
    rows = ownership.effective_positions(positions, filings).join(cusips.select("cusip"), "cusip", "left_semi")
    named = rows.join(parties.select(F.col("party").alias("manager"), "name"), "manager")
    return named.orderBy(F.desc("period"), "name", "cusip", "security_class", "put_call").limit(LISTED)


def company_beneficial(reports: DataFrame, filings: DataFrame, parties: DataFrame, issuer: str) -> DataFrame:
    rows = ownership.latest_beneficial(reports.where(F.col("issuer") == issuer), filings)
    return rows.join(parties.select(F.col("party").alias("owner"), "name"), "owner").orderBy(F.desc("event_date"), F.desc("filing_date"), "name", "security").limit(LISTED)


def company_insider(holdings: DataFrame, transactions: DataFrame, filings: DataFrame, parties: DataFrame, issuer: str) -> DataFrame:
    mine = [t.where(F.col("issuer") == issuer) for t in (holdings, transactions)]
    rows = ownership.latest_insider(*mine, filings)
    named = rows.join(parties.select(F.col("party").alias("owner"), "name"), "owner")
    return named.orderBy(F.desc("as_of"), "name", "security", "is_derivative", "direct_or_indirect").limit(LISTED)


def company_trades(transactions: DataFrame, filings: DataFrame, issuer: str) -> DataFrame:
    """Transactions of an issuer's insiders, latest first."""
    done = filings.where("status = 'processed'").select("accession", "filing_date")
    rows = transactions.where(F.col("issuer") == issuer).join(done, "accession")
    return rows.orderBy(F.desc("transaction_date"), F.desc("filing_date"), F.desc("accession"), "row_number").limit(LISTED_TRADES)


def coverage_report(status: DataFrame, listed: DataFrame) -> DataFrame:
    """Every filing of the index with its status and missing core metrics, by company, date and accession; listed:
    facts.presence_by_filing."""
    missing = listed.select("accession", F.array_join(F.col("by_tier")["core"], ",").alias("missing"))
    rows = status.join(missing, "accession", "left").withColumn("missing", F.when(F.col("status") == "parsed", F.coalesce("missing", F.lit(""))).otherwise(""))
    return rows.orderBy("cik", "filing_date", "accession")


def coverage_filings(status: DataFrame, listed: DataFrame, f: DataFrame, dimensions: DataFrame) -> DataFrame:
    """Every filing of the index with its status and, where it is parsed, what facts.presence_by_filing says and the metrics
    that it reports under dimensions only (dimensional); report_order sorts it."""
    found = facts.dimensional_basic(f, dimensions).withColumn("__basic", F.lit(True))
    rows = status.join(listed, "accession", "left").join(found, "accession", "left")
    evidence = F.create_map(F.lit("eps_diluted"), F.array(F.lit("eps_basic")))  # as facts.dimensional_evidence, without a second reading of listed
    rows = rows.withColumn("dimensional", F.when(F.col("__basic") & F.array_contains("missing", "eps_diluted"), evidence)).drop("__basic")
    parsed = {c: F.when(F.col("status") == "parsed", F.col(c)) for c in ("metrics", "missing", "by_tier", "related", "dimensional")}
    return rows.withColumns(parsed)


def report_order(report: DataFrame) -> DataFrame:
    """By company, date and accession. A sort reads its input twice: store it."""
    return report.orderBy("cik", "filing_date", "accession")


def coverage_totals(report: DataFrame) -> DataFrame:
    """One row of a report of coverage_filings: filings by status, those with missing metrics, and by_tier, the number of them
    in each tier. The report is read three times: store it."""
    tiers = report.select(F.explode(F.map_keys("by_tier")).alias("tier")).groupBy("tier").agg(F.count("*").alias("n"))  # a few rows
    by_tier = tiers.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("tier", "n")))).alias("by_tier"))
    missing = report.where(F.size("missing") > 0).select("accession")
    return events.coverage_summary(report, missing).crossJoin(by_tier)


def coverage_requests(status: DataFrame, quarters: DataFrame) -> DataFrame:
    """What has to be fetched: index quarters by year, and missing filings by company, form and year; kind, year, quarters,
    cik, form, filings, in order of kind, year, company and form."""
    index = quarters.groupBy("year").agg(F.array_sort(F.collect_set("quarter")).alias("quarters"))
    index = index.select(F.lit("index").alias("kind"), F.col("year").cast("int").alias("year"), "quarters", F.lit("").alias("cik"), F.lit("").alias("form"), F.lit(0).cast("long").alias("filings"))
    none = F.array().cast(index.schema["quarters"].dataType)
    gone = events.acquisition(status).select(F.lit("filings").alias("kind"), F.col("year").cast("int").alias("year"), none.alias("quarters"), "cik", "form", "filings")
    return gone.unionByName(index).orderBy("kind", "year", "cik", "form")


def write_report(report: DataFrame, path: str, *, form: str = "json") -> None:
    """A report as JSON lines, or as text with a tab between the columns."""
    if form not in ("json", "text"):
        raise ValueError("a report is written as json or text")
    if form == "json":
        report.write.json(path)
    else:
        report.select(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in report.columns]).alias("value")).write.text(path)


def quarter_requests(missing: DataFrame) -> DataFrame:
    """Index quarters that have to be fetched, beside the filings of events.acquisition."""
    return missing.select(F.lit("index").alias("kind"), "year", "quarter").orderBy("kind", "year", "quarter")


def taxonomy_report(values: DataFrame, f: DataFrame, contexts: DataFrame, dimensions: DataFrame, concepts: DataFrame) -> DataFrame:
    """Per filing: source coverage and the number of lint issues."""
    issues = facts.lint(values).groupBy("accession").agg(F.count("*").alias("issues"))
    return facts.source_coverage(f, contexts, dimensions, concepts).join(issues, "accession", "left").na.fill(0, ["issues"])


def validation(status: DataFrame, checks: DataFrame, gaps: DataFrame, exceptions: DataFrame) -> DataFrame:
    """One row: totals of missing and unparsed filings, failed checks and unexplained gaps, and the gate."""
    totals = status.agg(F.count_if(F.col("status") == "missing").alias("missing"), F.count_if(F.col("status") == "downloaded").alias("unparsed"))
    totals = totals.crossJoin(checks.agg(F.count_if(F.col("status") == "fail").alias("failed_checks")))
    return events.gate(totals.crossJoin(events.split_exceptions(gaps, exceptions)[1].agg(F.count("*").alias("unexplained"))))


def baseline_check(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Numbers of matching, differing and missing values of a manual baseline."""
    return facts.compare_baseline(expected, actual).groupBy("status").agg(F.count("*").alias("n"))


def news_page(news: DataFrame, **filters) -> DataFrame:
    """The page of news that fits, each line with the totals of all news."""
    return predicates.news_filter(news, **filters).crossJoin(events.news_overview(news).select("items", F.col("selected").alias("all_selected")))


def market_status(work: DataFrame) -> DataFrame:
    """Securities by what they need next."""
    return work.groupBy("kind").agg(F.count("*").alias("securities"))


def market_report(securities: DataFrame, prices: DataFrame, actions: DataFrame, state: DataFrame) -> DataFrame:
    """The overview beside the price coverage of all securities, one row."""
    return market.overview(securities, prices, actions, state).crossJoin(market.price_coverage(prices).select("first", "last"))


def import_index(index: DataFrame, known: DataFrame, *, year: int = 2016) -> DataFrame:
    """Filings of an index from the boundary on that are not known, once each by the accession in their path."""
    rows = predicates.pipeline_boundary(index, year=year).withColumn("accession", fn.accession_from_path(F.col("path"))).where("accession is not null")
    first = rows.groupBy("accession").agg(F.min(F.struct("filing_date", "cik", "form", "company", "path")).alias("f")).select("accession", "f.*")
    return first.join(known.select("accession"), "accession", "left_anti")


def reconcile_index(index: DataFrame, processed: DataFrame, **filters) -> DataFrame:
    """Index rows that pass the filters and were never processed."""
    return predicates.index_filter(index, **filters).join(processed.select("accession"), "accession", "left_anti")


def import_ownership(index: DataFrame, stored: DataFrame, version: int) -> DataFrame:
    """Ownership filings to import, once each: supported forms without a usable stored outcome."""
    rows = index.withColumn("o", predicates.ownership_family(F.col("form"))).where("o.supported").select("*", "o.family", "o.amendment").drop("o")
    once = events.first_seen(rows, ["accession"], "filing_date")
    return predicates.needs_import(once, stored, version)


def land_prices(current: DataFrame, state: DataFrame, batch: DataFrame, from_date: str, through: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(prices, state, rejects) after a batch of validated prices: rows by day replaced, watermarks widened."""
    none = batch.limit(0).select("security", "date", *[F.lit(None).cast(t).alias(c) for c, t in (("action_type", "string"), ("amount", "double"), ("numerator", "double"), ("denominator", "double"))])
    good, bad = predicates.validate_batch(batch, none, from_date, through)
    prices = market.apply_prices(current, good.select(*current.columns))
    seen = good.groupBy("security").agg(F.min("date").alias("covered_from"), F.max("date").alias("covered_through"))
    results = seen.select("*", F.col("covered_from").alias("observed_from"), F.col("covered_through").alias("observed_through"), F.lit(False).alias("reconcile"))
    return prices, market.advance_state(state, results), bad


def price_pass(stored: sync.Market, securities: DataFrame, provider: sync.Answers, retained: tuple[DataFrame, DataFrame, DataFrame], *, start: str, through: str, now: str, max_items: int | None = None) -> tuple[DataFrame, sync.Answers]:
    """(judged items, their answers) of one pass over what the securities need from `start` to `through`.

    provider: rows (without recovered) and errors; retained: the batches that market.chosen_batches gives from `start` on (read
    three times: store them), batch prices and batch actions, which serve bootstraps first. sync.applied gives the tables
    after the pass.
    """
    needs = market.work_queue(market.work(securities, stored.prices, stored.state, stored.repairs, start, through), max_items=max_items)
    queue = sync.ready(needs, stored.state, now)
    items, prices, actions = sync.retained_answers(queue, *retained)

    def both(kept: DataFrame, told: DataFrame) -> DataFrame:
        return kept.withColumn("recovered", F.lit(True)).unionByName(told.select(*kept.columns).withColumn("recovered", F.lit(False)))

    answers = sync.Answers(both(prices, provider.prices), both(actions, provider.actions), provider.errors)
    return sync.judged_items(both(items, queue), answers), answers


def ownership_status(filings: DataFrame, coverage: DataFrame, version: int, *, from_date: str, through: str) -> DataFrame:
    """Outcome counts by family and status beside the latest completed coverage."""
    latest = ownership.latest_coverage(coverage, version).select("family", "completed")
    return ownership.outcome_counts(filings, from_date=from_date, through=through).join(latest, "family", "left")


def requeue(rows: DataFrame, *, stage: str = "") -> DataFrame:
    """Failures after a requeue: open ones, of one stage or all, start again at no attempts."""
    chosen = ~F.col("resolved") & (F.lit(not stage) | (F.col("stage") == stage))
    return rows.withColumn("attempts", F.when(chosen, 0).otherwise(F.col("attempts")))


def feed_cycle(feed: DataFrame, processed: DataFrame) -> DataFrame:
    """Events of a feed that are new: their accessions are not processed yet."""
    return feed.join(processed.select("accession"), "accession", "left_anti")
